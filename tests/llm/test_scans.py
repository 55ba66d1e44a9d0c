import random
import re

import duckdb
import pytest
from edges import ROWS, corpus, edge_docs
from pyspark.sql import functions as F

from windflow.llm import licenses, queries, templates, urls

QUESTION = ("Alice has 12 apples and gives 5 apples to Bob. Alice then drives 30 km in 2 hours with 12 friends "
            "who each weigh 60 kg before the long day ends.")


def asked(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def found(docs, benchmark, **options):
    return {(r["doc_id"], r["item_id"]): r for r in templates.contaminated(docs, benchmark, **options).collect()}


def documents(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_question_with_other_values_is_found(spark):
    changed = (QUESTION.replace("12", "48").replace("Alice", "Carol").replace("30 km", "75 miles"))
    mixed = QUESTION.replace("12 apples", "48 apples")  # 12 becomes 48 in one place only
    docs = documents(spark, "Intro. " + QUESTION + " Outro.", "More words first. " + changed, mixed,
                     "Nothing of the kind is here, only words that go on for a while without any question.")
    got = found(docs, asked(spark, QUESTION))
    assert set(got) == {(0, 0), (1, 0)}
    assert got[0, 0]["n_changed"] == 0 and got[1, 0]["n_changed"] >= 3


def test_two_values_may_become_one(spark):
    merged = QUESTION.replace("12", "5").replace("60 kg", "5 kg")
    assert set(found(documents(spark, merged), asked(spark, QUESTION))) == {(0, 0)}


def test_windows_that_agree_count_beside_a_contradiction(spark):
    mixed = QUESTION.replace("12 apples", "48 apples")
    got = found(documents(spark, mixed), asked(spark, QUESTION), all_slots=False)
    assert set(got) == {(0, 0)} and got[0, 0]["n_changed"] == 1
    assert templates.agreeing([(0, {("a", "b")}), (1, {("a", "c")}), (2, {("a", "b")}), (3, {("a", "a")})], False) == (3, 1)
    assert templates.agreeing([(0, {("a", "b")}), (1, {("a", "c")})], True) == (0, 0)


def test_names_that_begin_a_sentence_or_have_two_words(spark):
    short = "Bob has 5 apples. Bob buys 3 more apples. Bob eats 2 apples. Bob gives 1 apple away."
    long = ("The baker Alice sells 4 loaves at noon, and then Alice walks home with Alice's dog while Alice sings. "
            "In the evening the mayor calls Alice and the two talk about Alice.")
    docs = documents(spark, "So. " + short.replace("Bob", "Eve"), short.replace("Bob", "Mary Ann").replace("5", "9"),
                     long.replace("Alice", "Mary Ann"), long.replace("Alice", "Anne-Marie Lou"), short)
    for all_slots in (True, False):
        got = found(docs, asked(spark, short, long), all_slots=all_slots)
        assert set(got) == {(0, 0), (1, 0), (2, 1), (3, 1), (4, 0)}
        assert got[2, 1]["share"] == got[0, 0]["share"] == got[4, 0]["share"] == 1 and got[4, 0]["n_changed"] == 0


def test_questions_without_a_usable_window(spark):
    sums, chinese, both = "Compute 12 + 7 * 3 - 4 / 2 + 9", "小明有五个苹果，他又买了三个。", "What is 2 ^ 10?"
    items = asked(spark, sums, chinese, both, "", None)
    docs = documents(spark, f"Warm-up. {sums.replace(' 9', '  9')}, then rest.", f"请看{chinese}答案", both,
                     "Compute 12 - 7 * 3 - 4 / 2 + 9", "小明有五个苹果，他又买了四个。", "What is 2", "^ 10 what is 2", "")
    for options in ({}, {"held": 1}):
        got = found(docs, items, **options)
        assert set(got) == {(0, 0), (1, 1), (2, 2)} and {r["share"] for r in got.values()} == {1.0}


def test_passes_over_a_large_benchmark_agree(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    one = {k: tuple(r) for k, r in found(docs, benchmark).items()}
    assert one and one == {k: tuple(r) for k, r in found(docs, benchmark, held=200).items()}


def test_whole_questions_in_the_corpus(spark, sf):
    docs, rows = corpus(spark, sf)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    squeezed = {d: " ".join((t or "").split()) for d, t in rows}
    holders = {d for d, t in squeezed.items() for _, q in items if " ".join(q.split()) in t}
    assert holders and holders == {r["doc_id"] for r in queries.op4_benchmark_decontamination(spark, sf).collect()}


def changed_values(text, draw):
    """The question with other numbers and, inside sentences, other names, each the same way throughout."""
    becomes = {}

    def other(m):
        word = m.group()
        if word not in becomes:
            becomes[word] = str(draw.randint(2, 999)) if word[0].isdigit() else draw.choice(["Zora", "Quill", "Benno"])
        return becomes[word]
    return re.sub(r"\b\d+\b|(?<=[a-z,] )[A-Z][a-z]+\b", other, text)


def test_recall_of_questions_with_other_values(spark, sf):
    draw = random.Random(3)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    stories = [(10_000 + i, f"On day {draw.randint(1, 400)} {a} took {draw.randint(2, 90)} {b} from the old shed, and when "
                            f"it rained {a} put {draw.randint(2, 90)} of them under the long table near the door.")
               for i, (a, b) in enumerate([("Alice", "lamps"), ("Bob", "ropes"), ("Carla", "crates"), ("Dan", "bells")] * 10)]
    asked_for = items + stories
    rows = [(i, f"Some words first. {changed_values(t, draw)} And some after it.") for i, t in asked_for]
    got = found(spark.createDataFrame(rows, "doc_id long, text string"),
                spark.createDataFrame(asked_for, "item_id long, text string"), all_slots=False)
    assert any(t != u for (_, t), (_, u) in zip(stories, rows[len(items):]))
    assert sum((i, i) in got for i, _ in asked_for) >= 0.9 * len(asked_for)
    docs, plain = corpus(spark, sf)
    squeezed = {d: " ".join((t or "").split()) for d, t in plain}
    clean = [d for d, t in squeezed.items() if not any(" ".join(q.split()) in t for _, q in items)]
    named = {d for d, _ in found(docs, spark.createDataFrame(asked_for, "item_id long, text string"), all_slots=False)}
    assert clean and not named & set(clean)


def test_common_windows_bring_nothing_together(spark):
    common = "please read all of the following lines with care"
    items = [f"{common} before you answer how the {a} {b} {c} reached that small harbour town" for a in ("red", "old")
             for b in ("ship", "boat") for c in ("really", "never")]
    docs = documents(spark, *[f"{common} and nothing else is here at all in number {'x' * i}" for i in range(30)], items[0])
    assert {d for d, _ in found(docs, asked(spark, *items))} == {30}
    seen = spark.createDataFrame([(d, 8, 1, "t") for d in range(9)] + [(9, 8, h, "t") for h in (1, 2, 3)],
                                 "doc_id long, size int, hash long, template string")
    windows = spark.createDataFrame([(i, at, 8, h, "t", 4) for i in range(3) for at, h in enumerate((1, 2, 3, 4))],
                                    "item_id long, at long, size int, hash long, template string, n_windows long")
    likely = {tuple(r) for r in templates._likely(seen, windows).collect()}
    assert likely == {(9, i) for i in range(3)}


def test_decontamination_edges(spark):
    benchmark = spark.createDataFrame([(1, None), (2, ""), (3, "too short"), (None, QUESTION), (4, QUESTION), (5, QUESTION)],
                                      "item_id long, text string")
    assert found(edge_docs(spark), benchmark) == {}
    rows = [*ROWS, (90, QUESTION), (90, QUESTION), (None, QUESTION)]
    assert set(found(edge_docs(spark, rows), benchmark)) == {(90, 4), (90, 5)}
    assert found(edge_docs(spark, []), benchmark) == {} == found(edge_docs(spark, rows), benchmark.limit(0))
    five = asked(spark, "Seven purple ducks swim sideways")
    assert set(found(documents(spark, "Then seven purple ducks swim sideways again."), five)) == {(0, 0)}


def plain_runs(text):
    words = [w for w in "".join(c if ord(c) > 127 or c.isalnum() else " " for c in text.lower()).split(" ") if w]
    return {tuple(words[i:i + 3]) for i in range(len(words) - 2)}


def test_licences_against_all_runs(spark, sf):
    docs, rows = corpus(spark, sf)
    notices = list(licenses.NOTICES.values())
    rows = [*rows, *((10_000 + i, f"x{i} y {'z ' * i}{n} and {'more ' * i}") for i, n in enumerate(notices * 3)),
            (20_000, "Redistribution and use in source and binary forms, with or without modification, is fine")]
    expected = {}
    for d, t in rows:
        own = plain_runs(t)
        for name, notice in licenses.NOTICES.items():
            runs = plain_runs(notice)
            if len(own & runs) >= 0.8 * len(runs):
                expected[d, name] = (len(runs), len(own & runs))
    got = {(r["doc_id"], r["license"]): (r["n_runs"], r["n_found"]) for r in
           licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(expected) >= 30 and got == expected


def test_licence_edges(spark):
    rows = [*ROWS, (95, "Released under the MIT License."), (95, "Released under the MIT License."),
            (None, "Released under the MIT License.")]
    got = licenses.scan(edge_docs(spark, rows)).collect()
    assert [(r["doc_id"], r["license"], r["containment"]) for r in got] == [(95, "MIT", 1.0)]
    assert licenses.scan(edge_docs(spark, [])).collect() == []
    none = spark.createDataFrame([], "license string, notice string")
    assert licenses.scan(edge_docs(spark, rows), none).collect() == []
    with pytest.raises(ValueError):
        licenses.scan(edge_docs(spark), licenses.notice_table(spark, {"x": "too few words"}))


def test_scattered_words_are_no_licence(spark):
    text = licenses.NOTICES["MIT/text"]
    halves = text[:500] + " more words " * 300 + text[500:]
    gpl = "You may use it {}under the terms of the GNU General Public License as published by the Free Software " \
          "Foundation, either version 3 of the License, or (at your option) any later version. More."
    rows = [(1, "released under the sun and sky, under the mit roof, by the mit license plate"),
            (2, "# " + text.replace(" Software", "\n#  Software") + " end"), (3, halves), (4, gpl.format("")),
            (5, " ".join(["released under the", "words " * 40, "under the mit"] * 40) + " the mit license"),
            (6, "Released under"), (6, "the MIT License."), (7, "go " * 50_000 + "Released under the MIT License. ")]
    got = {(r["doc_id"], r["license"]): r for r in
           licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {n for d, n in got if d in (1, 5, 6)} == set()
    assert got[2, "MIT/text"]["containment"] == 1.0 and got[2, "MIT/text"]["spdx"] == "MIT"
    assert {n for d, n in got if d == 3} == {"MIT/grant"} and {n for d, n in got if d == 7} == {"MIT"}
    headers = {n: got[4, n]["closest"] for d, n in got if d == 4 and n.endswith("/header")}
    assert headers["GPL-3.0-or-later/header"] and headers["GPL-2.0-or-later/header"] is False


def test_licence_tags(spark):
    rows = [(1, "// SPDX-License-Identifier: MIT"), (2, "spdx-license-identifier: (GPL-2.0-only WITH "
            "Classpath-exception-2.0 OR BSD-3-Clause) AND MIT. AND more"), (3, "SPDX-License-Identifier:"), (4, None),
            (1, "SPDX-License-Identifier: MIT"), (5, " AND MIT"), (None, "SPDX-License-Identifier: MIT"),
            (6, "SPDX-License-Identifier: MIT and then\nSPDX-License-Identifier: ISC")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spdx", F.lit("clash"))
    got = sorted((r["doc_id"], r["license"]) for r in licenses.scan(docs).collect())
    assert got == [(1, "MIT/tag"), (2, "BSD-3-Clause/tag"), (2, "GPL-2.0-only/tag"), (2, "MIT/tag"),
                   (6, "ISC/tag"), (6, "MIT/tag")]
    assert licenses.scan(docs, licenses.notice_table(spark)).collect() == []


def test_notices_have_a_bound(spark):
    with pytest.raises(ValueError):
        licenses.scan(documents(spark, "x"), licenses.notice_table(spark, {"x": "many words " * licenses.MOST_RUNS}))


def test_licence_scan_is_native(spark, sf):
    plan = queries.op6_license_scan(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def pages_of(spark, *links):
    return spark.createDataFrame(list(enumerate(links)), "page_id long, url string").select(
        "*", *[F.lit(None).cast("string").alias(c) for c in ("host", "path", "template", "segment", "good", "n")])


def test_rules_and_parts(spark):
    pages = pages_of(spark, "http://a.com/x?y#z", "HTTPS://Www.Example.COM/en/1", "https://b.example.com/en/1",
                     "https://example.com/en", "x://n.net/es/1", "x://net/fr/", "x://anet/fr/", None, "no scheme/en/",
                     "://q.com?x/y", "a://b.com#/z", "p://c.org/a://d.com/", "x://É.COM/", "")
    labels = spark.createDataFrame([], "page_id long, good int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"])
           for r in urls.judged(pages, labels, queries.RULES).collect()}
    assert got == {
        0: ("a.com", "/x", "com/", "allow"), 1: ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        2: ("b.example.com", "/en/1", "example.com/en/", "block"), 3: ("example.com", "/en", "com/", "allow"),
        4: ("n.net", "/es/1", "net/es/", "block"), 5: ("net", "/fr/", "net/fr/", "block"),
        6: ("anet", "/fr/", None, "allow"), 7: ("", "", None, "allow"), 8: ("", "", None, "allow"),
        9: ("q.com", "", None, "allow"), 10: ("b.com", "", None, "allow"), 11: ("c.org", "/a://d.com/", None, "allow"),
        12: ("É.com", "/", "com/", "allow"), 13: ("", "", None, "allow")}
    assert urls.judged(pages.limit(0), labels, []).collect() == []


def test_branches_that_differ_stay_apart(spark):
    links = [f"h://s.org/{part}/{i}" for part in ("good", "bad", "fine") for i in range(60)]
    pages = pages_of(spark, *links)
    labels = spark.createDataFrame([(i, int("/bad/" not in u)) for i, u in enumerate(links)], "page_id long, good int")
    got = urls.judged(pages, labels, []).collect()
    assert {r["template"] for r in got if "/bad/" in r["path"]} == {"/bad/*"}
    assert all((r["verdict"] == "block") == ("/bad/" in r["path"]) for r in got)
    deep = urls.judged(pages_of(spark, "h://s.org/a/b/c/d/e/f"), labels.limit(0), []).first()
    assert deep["template"] == "/*/*/*/*/**"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    ours, theirs = queries.QUERIES[name](spark, sf).toPandas(), con.sql(queries.ORACLE[name]).df()
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)

    def plain(frame):
        return sorted(str([x.item() if hasattr(x, "item") else x for x in r])
                      for r in frame[columns].astype(object).where(frame[columns].notna(), None).itertuples(index=False))
    assert plain(ours) == plain(theirs) and len(ours)


def test_repeated_pages_stay_as_many(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").limit(50)
    thrice = pages.union(pages).union(pages).union(pages.limit(2).withColumn("page_id", F.lit(None).cast("long")))
    docs, labels = (spark.read.parquet(f"{sf}/{name}.parquet") for name in ("documents", "labels"))
    got = urls.judged(thrice, urls.labels_by_title(thrice, docs, labels), queries.RULES).collect()
    assert len(got) == 152
    assert len({(r["page_id"], r["verdict"]) for r in got if r["page_id"] is not None}) == 50
