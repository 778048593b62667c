"""Operators for preparing training data for language models. Nothing else in the library imports them."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Functions for tasks travel with their code, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
