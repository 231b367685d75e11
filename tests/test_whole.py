"""Operators over groups that are cut for scale, against the plain definition over the whole group."""

import random
import re

import pytest

from textloom.operators import aggregates, joins, retrieval
from textloom.plans import models, selection


class Given:
    """Tables made in a test."""

    def __init__(self, spark, **tables):
        self.spark = spark
        self.__dict__.update(tables)


@pytest.mark.parametrize("block", [3, 4000])
def test_sections_meet_every_other_of_their_document(spark, block):
    rng = random.Random(block)
    rows = [(i, rng.choice(["d", "e", "f"]), rng.choice([f"{k}.1" for k in range(20)] + [None])) for i in range(60)] + [(100, "two", "1"), (101, "two", "2")]
    terms = {i: [rng.choice("abcdefghijklmnop") for _ in range(rng.randint(0, 5))] for i, *_ in rows} | {100: ["x", " Y"], 101: ["y", "z"]}
    t = Given(spark, passages=spark.createDataFrame(rows, "id bigint, doc_sha256 string, section_path string"), passage_vocabulary=spark.createDataFrame(list(terms.items()), "id bigint, lemmas array<string>"))
    own = {i: {x.strip().lower() for x in terms[i]} for i, _, path in rows if path}
    doc = {i: d for i, d, _ in rows}
    first = {}
    for a in own:
        if found := [(-n, b) for b in own if b != a and doc[a] == doc[b] and (n := len(own[a] & own[b]))]:
            first[a] = min(found)
    taken, want = set(), set()
    for a in sorted(first, key=lambda a: (first[a][0], a)):
        b = first[a][1]
        if frozenset((a, b)) not in taken:
            taken.add(frozenset((a, b)))
            third = first[b][1]
            want.add((a, b, third if third not in (a, b) else -1))
    got = [tuple(r) for r in models.section_partners(t, block).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert (100, 101, -1) in want


@pytest.mark.parametrize("seed", range(2))
def test_every_repeat_is_refused_as_in_order(spark, seed):
    rng = random.Random(seed)
    said = [" ".join(rng.sample("abcdefgh", rng.randint(4, 8))) + rng.choice(["", "", " 7", " 7 12"]) for _ in range(150)]
    rows = list(enumerate(said + ["Plain words here", "plain words here!", "...", "...", None]))
    rng.shuffle(rows)
    kept, want = [], set()
    for i, text in sorted(rows):
        words = set(re.findall(r"\w+", (text or "").lower()))
        own = sorted(x for x in re.findall(r"\w+", text or "") if x.isdigit())
        if not words:
            continue
        hit = next((k for k, n, x in kept if n == own and len(words & x) >= 0.8 * len(words | x)), None)
        if hit is None:
            kept.append((i, own, words))
        else:
            want.add((i, hit))
    got = [tuple(r) for r in selection.sequential_dedup(Given(spark, facts=spark.createDataFrame(rows, "id bigint, statement string"))).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert (151, 150) in want


@pytest.mark.parametrize("size, stretch", [(3, 4), (2, 3), (4, 5), (3, 2000)])
def test_facts_are_dealt_once_a_document_over_stretches(spark, size, stretch):
    rng = random.Random(size * stretch)
    passages = [(i, rng.choice("de"), rng.choice([None, *range(40)])) for i in range(80)]
    cited = [(rng.randint(0, 60), i) for i, *_ in passages for _ in range(rng.choice([0, 1, 1, 2, 5]))]
    want = set()
    for doc in "de":
        spent, sample, open_ = set(), 0, []
        for ordinal, i in sorted(((-1 if o is None else o), i) for i, d, o in passages if d == doc):
            for fact in sorted({f for f, p in cited if p == i} - spent):
                spent.add(fact)
                open_.append(fact)
                if len(open_) == size:
                    want |= {(doc, sample, f) for f in open_}
                    sample, open_ = sample + 1, []
            if len(open_) > 1:
                want |= {(doc, sample, f) for f in open_}
                sample, open_ = sample + 1, []
        want |= {(doc, sample, f) for f in open_}
    t = Given(spark, passages=spark.createDataFrame(passages, "id bigint, doc_sha256 string, ordinal int"), fact_passages=spark.createDataFrame(cited, "fact_id bigint, passage_id bigint"))
    got = [tuple(r) for r in selection.dealt_samples(t, size, stretch).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_topics_are_fitted_on_all_terms(spark):
    groups = [[f"f{g}x{i}" for i in range(100)] for g in range(15)] + [[f"z{i}" for i in range(10)]]
    rows = [(10 * g + i, "en", terms) for g, terms in enumerate(groups) for i in range(3 if g == 15 else 4)]
    got = selection.topic_memberships(Given(spark, passage_vocabulary=spark.createDataFrame(rows, "id bigint, language string, lemmas array<string>")), 16).collect()
    assert {r["id"] for r in got} == {i for i, *_ in rows}  # 1,500 terms are more frequent than those of the last three
    assert all(0.15 <= r["weight"] <= 1 for r in got)


@pytest.mark.parametrize("seed", range(2))
def test_repeats_among_all_questions(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["de", "en", None]), rng.choice([True, True, False]), rng.choice(["easy", "hard", None]), " ".join(rng.sample("abcdefghij", rng.randint(1, 6)))) for i in range(120)]
    rows += [(200, "en", True, "easy", "When does the gate open"), (201, "en", True, None, "From when does the gate open")]
    of = {i: {rng.randint(0, 50) for _ in range(rng.randint(0, 3))} for i, *_ in rows}
    on = {f: {rng.randint(0, 30)} for f in range(51)}
    want = set()
    for i, language, answerable, _, text in rows:
        found = []
        for j, other, can, _, said in rows:
            if j < i and other == language:
                a, b = set(text.lower().split()), set(said.lower().split())
                facts = bool(of[i] & of[j])
                passages = bool(set().union(*(on[f] for f in of[i])) & set().union(*(on[f] for f in of[j])))
                bar = (0.5 if can and facts else None) if answerable != can else 0.5 if facts or passages else 0.75
                if bar and len(a & b) / len(a | b) >= bar:
                    found.append((-round(len(a & b) / len(a | b) - bar, 6), j))
        if found:
            above, near = min(found)
            want.add((i, near, -above))
    t = Given(
        spark,
        questions=spark.createDataFrame(rows, "id bigint, language string, answerable boolean, difficulty string, question_text string"),
        question_facts=spark.createDataFrame([(i, f) for i, x in of.items() for f in x], "question_id bigint, fact_id bigint"),
        fact_passages=spark.createDataFrame([(f, p) for f, x in on.items() for p in x], "fact_id bigint, passage_id bigint"),
    )
    got = [tuple(r) for r in retrieval.repeated_questions(t).collect()]
    assert len(got) == len(want) and {(i, j) for i, j, _ in got} == {(i, j) for i, j, _ in want}
    assert (201, 200) in {(i, j) for i, j, _ in got}


def test_weights_owned_words_and_nearest_over_whole_tables(spark):
    vocabulary = spark.createDataFrame([(1, "de", ["a", "b"]), (2, "de", ["a", "c"]), (3, "en", ["a", "d", "d"]), (4, "en", ["e"]), (4, "en", ["e"])], "id bigint, language string, lemmas array<string>")
    got = {(r["id"], r["language"], r["term"]): r["weight"] for r in aggregates.tfidf_unit(Given(spark, passage_vocabulary=vocabulary)).collect()}
    assert got == {(1, "de", "a"): 0.0, (1, "de", "b"): 1.0, (2, "de", "a"): 0.0, (2, "de", "c"): 1.0, (3, "en", "a"): 0.447214, (3, "en", "d"): 0.894427, (4, "en", "e"): 1.0}
    documents = spark.createDataFrame([("x", 1, "one two"), ("x", 2, "Two three"), ("y", 3, "one"), (None, 4, "four")], "source string, doc_id bigint, text string")
    assert {tuple(r) for r in aggregates.owned_words(Given(spark, documents=documents)).collect()} == {("x", 1, "one"), ("x", 2, "three"), ("y", 3, "one")}
    vector = lambda *x: [float(v) for v in x] + [0.0] * 61
    rows = [(50, 0, vector(1, 0, 0)), (100, 0, vector(0, 1, 0)), (7, 1, vector(1, 0.1, 0)), (8, 1, vector(0, 1, 0.1))]
    pairs = joins.closest_pairs(Given(spark, embeddings=spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>"))).collect()
    assert {(r["a"], r["b"]) for r in pairs} == {(7, 50), (8, 100)}
