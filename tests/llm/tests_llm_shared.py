"""Plain versions that several tests use."""

import zlib

import numpy as np

from tillflow.llm import packing


def plain_repeats(words, width=5):
    """Words in windows found twice or more."""
    at = {}
    for i in range(len(words) - width + 1):
        at.setdefault(tuple(words[i : i + width]), []).append(i)
    return len({j for own in at.values() if len(own) > 1 for i in own for j in range(i, i + width)})


def brute_components(docs, width, percent):
    """Smallest id reachable for each document, by all pairs."""
    sets = {}
    for doc, text in docs.items():
        words = (text or "").encode().lower().split()
        sets[doc] = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set())
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.tokenizer_path())


def check_packing(docs, rows, capacity=1024):
    """Every id once, in pieces and sequences as promised."""
    known, pieces, bins = tokenizer(), {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(docs)
    for doc, own in pieces.items():
        ids = known.encode(docs[doc] or "", add_special_tokens=False).ids + [2]
        own = sorted(own, key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and sum(r.length for r in own) == len(ids)
        assert all(r.length == capacity for r in own[1:]) and len(own) == -(-len(ids) // capacity)
        at = 0
        for r in own:
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), sum(r.length for r in rows)
