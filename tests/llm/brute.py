"""Plain versions of the operators, for small inputs."""

import hashlib
import re

NO_ID = (1 << 63) - 1


def order(doc_id):
    return NO_ID if doc_id is None else doc_id


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def passages(docs, window=50):
    """{(doc_id, text): (n_words, n_removed, kept_sha256)}"""
    first = {}
    for doc_id, text in docs:
        w = words(text)
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, NO_ID), order(doc_id))
    out = {}
    for doc_id, text in docs:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < order(doc_id):
                gone.update(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out[doc_id, text] = (len(w), len(gone), sha(" ".join(kept).encode()))
    return out


def byte_strings(docs, window=100):
    """{(doc_id, text): (n_bytes, n_removed, n_spans, kept_sha256)}"""
    first = {}
    for doc_id, text in docs:
        b = (text or "").encode()
        for i in range(len(b) - window + 1):
            k, at = b[i:i + window], (order(doc_id), i)
            if k not in first or at < first[k]:
                first[k] = at
    out = {}
    for doc_id, text in docs:
        b = (text or "").encode()
        gone = bytearray(len(b) + 1)
        for i in range(len(b) - window + 1):
            if first[b[i:i + window]] < (order(doc_id), i):
                gone[i:i + window] = b"\1" * window
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out[doc_id, text] = (len(b), sum(gone), spans, sha(kept))
    return out


def lowered(text):
    return words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, n=5):
    w = lowered(text)
    if not w:
        return set()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)}


def near_groups(docs, percent=85, n=5):
    """{doc_id: (n_shingles, component_id, kept)} for documents with different ids."""
    sets = {doc_id: shingles(text, n) for doc_id, text in docs}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            parent[d] = parent[parent[d]]
            d = parent[d]
        return d

    holders = {}
    for d, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(d)
    for d, s in sets.items():
        common = {}
        for x in s:
            for e in holders[x]:
                if e < d:
                    common[e] = common.get(e, 0) + 1
        for e, both in common.items():
            if 100 * both >= percent * (len(s) + len(sets[e]) - both):
                a, b = root(d), root(e)
                parent[max(a, b)] = min(a, b)
    return {d: (len(s), root(d), root(d) == d) for d, s in sets.items()}


def thue_morse(n, first=b"a", other=b"b"):
    """A word of 2**n letters whose complement has the same value under any polynomial modulo 2**64."""
    word, complement = first, other
    for _ in range(n):
        word, complement = word + complement, complement + word
    return word.decode(), complement.decode()
