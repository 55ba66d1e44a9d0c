import zlib
from collections import Counter, defaultdict

import numpy as np
from edges import ROWS, corpus, edge_docs
from tokenizers import Tokenizer

from windflow.llm.packing import best_fit, packed, plan_rows, reduced
from windflow.llm.token_counts import quantile_length, token_counts
from windflow.llm.tokens import Coder, default_tokenizer

ODD = ["<|endoftext|>a b<|startoftext|>, c", "Ça va? É́ ﬁ Σας ΟΔΟΣ. İstanbul ǅ 3½", "it's DON'T we'll ..., 12,345",
       "x\x1cq\x1f 日本語テキスト 👍🏽", "...,,,", "¡hola! \x00\x01 ab​cd", "naïve café's l'été", "## ### a## ##b"]


def ids_of(texts):
    encoded = Tokenizer.from_file(default_tokenizer()).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [e.ids for e in encoded]


def pieces(rows):
    out = Counter()
    for (d, _), ids in zip(rows, ids_of([t for _, t in rows])):
        ids = [*ids, 0]
        for k in range(0, len(ids), 2048):
            part = np.array(ids[k:k + 2048], "<u4")
            out[d, k // 2048, k, len(part), zlib.crc32(part.tobytes())] += 1
    return out


def check(docs, rows):
    got = packed(docs).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == pieces(rows)
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in bins.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 2048
    return bins, got


def test_corpus_needs_no_more_than_it_must(spark, sf):
    bins, got = check(*corpus(spark, sf))
    assert len(bins) <= -(-sum(r["length"] for r in got) // 2048) + 1


def test_edges(spark):
    check(edge_docs(spark), ROWS)
    assert packed(edge_docs(spark, [])).collect() == []


def test_words_are_encoded_as_texts_are():
    coder = Coder(default_tokenizer())
    for text, ids in zip(ODD, ids_of(ODD)):
        assert coder.encode(text.encode()) == np.array(ids, "<u4").tobytes(), text


def counts_of(sizes, capacity):
    return np.bincount(sizes, minlength=capacity + 1).astype(np.int64)


def smallest(sizes, capacity):
    """The least number of bins, by trying."""
    best = len(sizes)

    def place(i, room):
        nonlocal best
        if len(room) >= best:
            return
        if i == len(sizes):
            best = len(room)
            return
        for k in {r: k for k, r in enumerate(room) if r >= sizes[i]}.values():
            place(i + 1, room[:k] + [room[k] - sizes[i]] + room[k + 1:])
        place(i + 1, room + [capacity - sizes[i]])
    place(0, [])
    return best


def test_reduction_never_costs_a_bin():
    rng = np.random.default_rng(5)
    for _ in range(150):
        sizes = sorted(rng.integers(1, 31, rng.integers(1, 10)).tolist(), reverse=True)
        counts = counts_of(sizes, 30)
        fixed = reduced(counts, 30)
        rest = [s for s in range(30, 0, -1) for _ in range(int(counts[s]))]
        assert sum(n for _, n in fixed) + smallest(rest, 30) == smallest(sizes, 30)


def test_plan_holds_every_piece_once():
    rng = np.random.default_rng(6)
    for _ in range(50):
        counts = counts_of(rng.integers(1, 65, 300), 64)
        before = counts.copy()
        plan = reduced(counts, 64)
        plan += best_fit(counts, 64)
        used = Counter()
        for held, bins in plan:
            assert sum(held) <= 64 and bins > 0
            for s in held:
                used[s] += bins
        assert all(used[s] == before[s] for s in range(65))
        assert len(plan_rows(plan)) == sum(len(h) for h, _ in plan)


def test_counts(spark, sf):
    for docs, rows in (corpus(spark, sf), (edge_docs(spark), ROWS)):
        lengths = [len(ids) for ids in ids_of([t for _, t in rows])]
        got = {r["context_limit"]: r for r in token_counts(docs).collect()}
        assert set(got) == set(lengths)
        for limit, r in got.items():
            within = [n for n in lengths if n <= limit]
            assert (r["n_docs"], r["docs_within"], r["docs_beyond"]) == (
                lengths.count(limit), len(within), len(lengths) - len(within))
            assert r["tokens_within"] == sum(within)
            assert r["tokens_truncated"] == sum(min(n, limit) for n in lengths)
            assert r["tokens_lost"] == sum(lengths) - r["tokens_truncated"]
            assert (r["total_docs"], r["total_tokens"]) == (len(lengths), sum(lengths))
    assert quantile_length(token_counts(docs), 0.5).first()["length"] == sorted(lengths)[(len(lengths) - 1) // 2]
    assert token_counts(edge_docs(spark, [])).collect() == []
