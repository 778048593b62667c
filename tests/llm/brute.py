"""Plain Python versions of the operators, and small tables with every awkward case."""

from __future__ import annotations

import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, name string, hash string, at string, size string"


def documents(spark, texts, sources=("a",), langs=("en",)):
    """Documents with the ids 0, 1, ... and columns whose names the operators use inside."""
    rows = [(i, t, langs[i % len(langs)], sources[i % len(sources)], None if t is None else len(t), "n", "h", "x", "s")
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def component_ids(texts, shingle=3, distance=3):
    prints = []
    for text in texts:
        words = [w for w in WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))]
        parts = [" ".join(words[i: i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    low = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= distance and low[j] < low[i]:
                    low[i], changed = low[j], True
    return prints, low


def repeated_bytes(texts, least=400):
    """(bytes, removed, spans, kept) of every text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i: i + least] for b in raw for i in range(len(b) - least + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - least + 1):
            if seen[b[i: i + least]] > 1:
                gone[i: i + least] = b"\1" * least
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def kept_lines(texts, lines=3, words=50):
    """The texts after line dedup, in the order of their ids; every run of enough lines or words is looked up."""
    seen, out = set(), []
    for text in texts:
        all_lines = (text or "").split("\n")
        some = [(i, x.strip(" \t\r\f\v")) for i, x in enumerate(all_lines)]
        some, gone = [x for x in some if x[1]], set()
        for start in range(len(some)):
            # A run of more lines is made of shorter ones.
            for end in range(start + 1, min(len(some), start + lines) + 1):
                run = tuple(x for _, x in some[start:end])
                if len(run) >= lines or sum(len(x.split()) for x in run) >= words:
                    if run in seen:
                        gone |= {i for i, _ in some[start:end]}
                    seen.add(run)
        out.append(None if text is None else "\n".join(x for i, x in enumerate(all_lines) if i not in gone))
    return out
