"""The ten operators on small made tables: defined results for nulls, blanks, ties, repeated rows, empty tables and clashing columns, and brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import arrivals, mixing, neardup, neighbours, packing, pairs, quality, sampling, scans, tokens, vocabulary

CLASH = {"n": 1, "r": 2, "rank": 3, "bucket": 4, "part": 5, "prefix": "x", "tokens": 6, "component": 7, "group": 8}


def clashing(df):
    for name, value in CLASH.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(value))
    return df


# 1 vocabulary


def test_burst_trie_equals_a_dict():
    rng, trie, want = random.Random(1), vocabulary.BurstTrie(4), Counter()
    for _ in range(5000):
        w = "".join(rng.choice("abü") for _ in range(rng.randint(0, 6)))
        trie.add(w, 2, 1)
        want[w] += 1
    got = {x: (o, r) for _, ts, os_, rs in trie.containers() for x, o, r in zip(ts, os_, rs)}
    assert got == {k: (2 * v, v) for k, v in want.items()}
    assert all(t.startswith(p) for p, ts, *_ in trie.containers() for t in ts)


def test_containers_of_all_workers_meet_along_their_routes(spark, monkeypatch):
    assert list(vocabulary.cut("", ["a", "ab", "abc", "abd", "b"], 2)) == [("a", 0, 1), ("ab", 1, 4), ("b", 4, 5)] and list(vocabulary.cut("abc", ["abcd", "abce"], 2)) == [("ab", 0, 2)]
    rng = random.Random(4)
    rows = [(i, "de" if i % 3 else "en", ["".join(rng.choice("abcü") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(0, 9))]) for i in range(3000)]
    df = spark.createDataFrame(rows, "id bigint, language string, lemmas array<string>").repartition(7)
    want = Counter((language, x) for _, language, xs in rows for x in xs)
    for deep in (10**6, 40):
        monkeypatch.setattr(vocabulary, "DEEP", deep)
        got = vocabulary.vocabulary(df).collect()
        assert {(r["language"], r["lemma"]): r["occurrences"] for r in got} == want and len(got) == len(want)


def test_vocabulary_rules(spark):
    rows = [(1, "de", ["A ", "a", None, " "]), (1, "de", ["A ", "a", None, " "]), (2, "de", ["b", "a"]), (3, "de", []), (4, "de", None), (5, None, ["a"]), (6, "en", ["x" * 5000]), (None, "de", ["b"]), (None, "de", ["b"])]
    df = clashing(spark.createDataFrame(rows, "id bigint, language string, lemmas array<string>"))
    got = {(r["language"], r["lemma"]): (r["occurrences"], r["passages"], r["of_passages"], r["rare"], r["common"]) for r in vocabulary.vocabulary(df).collect()}
    assert got == {("de", "a"): (3, 2, 4, True, False), ("de", "b"): (3, 3, 4, False, True), ("en", "x" * 5000): (1, 1, 1, True, True)}
    assert {tuple(r) for r in vocabulary.marks(vocabulary.vocabulary(df)).collect()} == {("de", "a", "rare"), ("de", "b", "common"), ("en", "x" * 5000, "rare"), ("en", "x" * 5000, "common")}
    assert vocabulary.vocabulary(df.limit(0)).count() == 0


# 2 arrivals


def _facts(spark, n=400, seed=0, hot=0.4):
    rng, base = np.random.default_rng(seed), []
    centres = rng.normal(size=(6, 64))
    for i in range(n):
        number = "7" if rng.random() < hot else str(rng.integers(1, 9))
        v = centres[rng.integers(6)] + rng.normal(size=64) * rng.choice([0.05, 0.3, 0.5])
        kind = rng.random()
        vector = None if kind < 0.05 else [0.0] * 64 if kind < 0.08 else [1.0] * 32 if kind < 0.1 else [float(x) for x in v]
        text = None if rng.random() < 0.03 else f"Word{rng.integers(12)} costs {number}" if rng.random() < 0.7 else f"No figure {rng.integers(5)}".replace("0", "zero") if rng.random() < 0.5 else f"same {number}"
        base.append((i + 1, int(i * 4 // n), text, vector))
    return base


def _brute(rows):
    known, out = [], set()
    for i, batch, text, vector in sorted(rows, key=lambda r: (r[1] if r[1] is not None else 99, r[0])):
        ws, num = tuple(re.findall(r"[^\W_]+", (text or "").lower())), sorted(re.findall(r"\d+", text or ""))
        v = np.array(vector) if vector is not None and len(vector) == 64 and any(vector) else None
        v = None if v is None else v / np.linalg.norm(v)
        hit = [k for k, w2, n2, v2 in known if (ws and ws == w2) or (v is not None and v2 is not None and num == n2 and v @ v2 >= 0.93)]
        if batch != 0 and hit:
            out.add((min(hit), i))
        else:
            known.append((i, ws, num, v))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_repeats_equal_brute_force_walked_and_in_rounds(spark, seed):
    rows = _facts(spark, seed=seed)
    df = clashing(spark.createDataFrame(rows, "id bigint, batch_no int, statement string, embedding array<float>"))
    postings, want = arrivals.indexed(df), _brute([(i, b, t, None if v is None else [float(np.float32(x)) for x in v]) for i, b, t, v in rows])
    assert {tuple(r) for r in arrivals.repeated(postings).collect()} == want
    assert {tuple(r) for r in arrivals.repeated(postings, hot=30, part=25).collect()} == want
    assert {tuple(r) for r in arrivals.repeated(postings.unionByName(postings)).collect()} == want
    assert arrivals.repeated(postings.limit(0)).count() == 0


def test_batches_against_a_kept_index_equal_one_pass(spark):
    rows = [r for r in _facts(spark, 200, 3)]
    df = spark.createDataFrame(rows, "id bigint, batch_no int, statement string, embedding array<float>")
    postings, index, got = arrivals.indexed(df), None, set()
    index = postings.filter("batch = 0")
    for batch in (1, 2, 3):
        repeats, accepted = arrivals.arrive(index, postings.filter(f"batch = {batch}"))
        got |= {tuple(r) for r in repeats.collect()}
        index = index.unionByName(accepted)
    want = {tuple(r) for r in arrivals.repeated(postings).collect()}
    assert got == want
    assert {tuple(r) for r in arrivals.replayed(postings).collect()} == want
    assert {tuple(r) for r in arrivals.replayed(postings.unionByName(postings), hot=30).collect()} == want
    kept = arrivals.Index(spark, parts=3)
    old = {tuple(r) for r in arrivals.replayed(postings.filter("batch <= 1"), index=kept).collect()}
    assert old | {tuple(r) for r in arrivals.replayed(postings.filter("batch > 1"), first=-1, index=kept).collect()} == want
    assert arrivals.replayed(postings.limit(0)).count() == 0


# 3 neighbours


def test_tree_is_exact_at_factor_one_and_near_beyond():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(40, 16))
    v = neighbours.unit(centres[rng.integers(40, size=6000)] + 0.3 * rng.normal(size=(6000, 16)))
    q, tree = v[::20], neighbours.Tree(v, leaf=64)
    want = np.sort(q.astype(np.float32) @ v.astype(np.float32).T, axis=1)[:, ::-1][:, :10]
    assert np.allclose(tree.search(q, 10)[0], want, atol=1e-5)
    exact = [set(x) for x in tree.search(q, 10)[1]]
    recall = np.mean([len(exact[i] & set(x)) / 10 for i, x in enumerate(tree.search(q, 10, 1.25)[1])])
    assert recall >= 0.9


def test_nearest_rules(spark):
    vectors = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.0]), (4, [0.0, 1.0]), (5, None), (6, [0.0, 0.0]), (7, [1.0]), (8, [1.0, None])]
    df = clashing(spark.createDataFrame(vectors, "id bigint, vector array<float>"))
    got = sorted((r["query"], r["place"], r["id"]) for r in neighbours.nearest(df, df, 2, width=2, shards=3).collect())
    assert got == [(1, 1, 2), (1, 2, 3), (2, 1, 1), (2, 2, 3), (3, 1, 1), (3, 2, 2), (4, 1, 1), (4, 2, 2)]
    assert neighbours.nearest(df, df.limit(0), 2, width=2).count() == 0 and neighbours.nearest(df.limit(0), df, 2, width=2).count() == 0


def test_ties_beyond_the_spare_places_go_by_id_in_every_shard(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [1.0, 0.0, 0.0, 0.0]) for i in range(300)] + [(1000 + i, [float(x) for x in rng.normal(size=4)]) for i in range(500)]
    df = spark.createDataFrame(rows, "id bigint, vector array<float>")
    for shards in (1, 4):
        got = {}
        for r in neighbours.nearest(df.filter("id IN (0, 7, 1003)"), df, 5, width=4, shards=shards).collect():
            got.setdefault(r["query"], {})[r["place"]] = r["id"]
        v = neighbours.unit(np.array([x for _, x in rows], dtype=np.float32))
        ids = np.array([i for i, _ in rows])
        for q, places in got.items():
            sims = v @ v[ids == q][0]
            order = [i for i in np.lexsort((ids, -np.round(sims, 12))) if ids[i] != q][:5]
            assert [places[p] for p in range(1, 6)] == ids[order].tolist()
        assert len(got) == 3


def test_copies_fill_one_leaf():
    v = neighbours.unit(np.ones((5000, 8)))
    assert neighbours.Tree(v, leaf=100).search(v[:3], 4)[0].min() > 0.999


# 4 scans


def test_page_lines_and_broken_words():
    title, source = "House Rules: Water Tap, Crinholt", "city-library"
    lines = ["House Rules: Water Tap, Crinholt | 2", "the tap is phot-", "- 2 -", "ographed twice a year, pre-", "and post-season. In Selan-", "Halis the co-", "owner says 2 | 3", "City Library – House Rules · 4", "Page 3 of 59", "(3)", "3.2 Rules", "2019"]
    kinds = scans.furniture(lines, title, source, (2, 2), frozenset(), "text")
    assert kinds == ["rn", "", "n", "", "", "", "", "rn", "n", "n", "", "n"]
    body = [x for x, k in zip(lines, kinds) if not k]
    assert [(a, b) for _, a, b, _ in scans.breaks(body)] == [("phot", "ographed"), ("Selan", "Halis"), ("co", "owner")]
    assert scans.furniture(["One line only"], title, source, None, frozenset(), None) == [""]
    assert scans.furniture(["LEAFLET: BULKY ITEM, PELENHAGEN", "the text"], None, None, None, frozenset({"leaflet"}), None)[0] == "r"


def test_scans_found_and_repaired(spark):
    plain = "Die Kennung steht auf dem Frachtzettel und nennt den Ort."
    rows = [(i, "d", plain, 1, 1, "text") for i in range(60)]
    rows += [(100, "d", "Die Kennnng steht\nauf dem Fracht-\nzettel und nennt den Ort.\nSeite 1", 1, 1, "text"), (101, "d", None, None, None, None), (102, "d", "", None, None, None), (103, "d", "Titel Eins\nDie Kennung steht auf dem Frachtzettel.", None, None, None), (104, None, "Co | 1 | 2\nEins | 3 | 4", None, None, "table"), (105, "d", "lang " * 60_000, 1, 1, "text")]
    p = clashing(spark.createDataFrame(rows + rows[-3:], "id bigint, doc_sha256 string, text string, page_from int, page_to int, block_type string")).withColumn("language", F.when(F.col("id") % 2 == 0, F.lit("de")))
    d = clashing(spark.createDataFrame([("d", "Titel Eins", "amt"), ("d", "Titel Eins", "amt"), (None, "x", "y")], "sha256 string, title string, source string"))
    s = scans.Scans(p, d)
    assert sorted(tuple(r) for r in s.found().collect()) == [(100, "hyphenation"), (100, "misread"), (100, "page_number"), (103, "running_line")]
    texts = {r["passage_id"]: r["text"] for r in s.repaired().collect()}
    assert texts[100] == "Die Kennung steht auf dem Frachtzettel und nennt den Ort." and texts[103] == "Die Kennung steht auf dem Frachtzettel." and texts[102] == "" and 101 not in texts
    empty = scans.Scans(p.limit(0), d.limit(0))
    assert empty.found().count() == 0 and empty.repaired().count() == 0


def test_anagram_join_finds_one_confusion_at_any_place(spark):
    words = [("nachtpforte", 400, ["de"]), ("naclitpforte", 3, ["de"]), ("nachfpforte", 2, []), ("nachtpfortc", 1, ["de", "en"]), ("tnachpforte", 2, ["de"]), ("wegen", 50, ["de"]), ("wagen", 30, []), ("light", 90, ["en"]), ("ligbt", 1, ["en"]), ("lighf", 1, ["de"])]
    got = {tuple(r) for r in scans.misread(spark.createDataFrame(words, "word string, n bigint, languages array<string>")).collect()}
    assert got == {("naclitpforte", "nachtpforte"), ("nachfpforte", "nachtpforte"), ("nachtpfortc", "nachtpforte")}


# 5 sampling

AXES = ["difficulty", "language"]


def _pool(spark, rows):
    return clashing(spark.createDataFrame(rows, "id bigint, difficulty string, language string"))


def _targets(spark, rows):
    return spark.createDataFrame(rows, "release_name string, size_pct int, axis string, category string, target_pct int, min_rows int")


def test_seats_equal_the_priorities_sorted():
    rng = np.random.default_rng(0)
    for _ in range(60):
        k = rng.integers(1, 7)
        counts, weights, size = rng.integers(0, 30, k), rng.random(k) * rng.integers(0, 2, k), int(rng.integers(0, 80))
        got = sampling.seats(counts, weights, np.zeros(k, dtype=np.int64), size)
        assert got.sum() == min(size, counts.sum()) and (got <= counts).all()
        if (weights > 0).all():
            every = sorted((r + 0.5) / weights[i] for i in range(k) for r in range(counts[i]))
            bar = every[got.sum() - 1] if got.sum() else 0
            assert all(got[i] == 0 or (got[i] - 0.5) / weights[i] <= bar + 1e-9 for i in range(k))


def test_report_and_draw(spark):
    rows = [(i, ["easy", "Hard ", None, "medium"][i % 4], "de" if i % 3 else "EN") for i in range(1200)]
    pool = _pool(spark, rows + rows[:50] + [(None, "easy", "de")])
    targets = _targets(spark, [("a", 30, "difficulty", "easy", 40, 1), ("a", 30, "difficulty", "hard", 40, 1), ("a", 30, "difficulty", "medium", 20, 1), ("a", 30, "language", "de", 50, 1), ("a", 30, "language", "en", 50, 1), ("b", 50, "difficulty", "hard", 90, 400), ("b", 50, "difficulty", "none", 10, 3)])
    got = {(r["release_name"], r["axis"], r["category"]): (r["places"], r["taken"], r["short"]) for r in sampling.report(pool, targets, AXES).collect()}
    assert got[("a", "difficulty", "hard")] == (144, 144, False) and got[("b", "difficulty", "hard")] == (540, 300, True) and got[("b", "difficulty", "none")] == (60, 0, True)
    drawn = sampling.draw(pool, targets, AXES).collect()
    assert len({(r["release_name"], r["id"]) for r in drawn}) == len(drawn)
    a = [r for r in drawn if r["release_name"] == "a"]
    assert len(a) == 360
    for axis, want in (("difficulty", {"easy": 144, "hard": 144, "medium": 72}), ("language", {"de": 180, "en": 180})):
        have = Counter(r[axis] for r in a)
        assert all(abs(have[k] - n) <= 6 for k, n in want.items())
    parts = sampling.shortfalls(sampling.draw(pool, targets, AXES), pool, targets, AXES).collect()
    assert {(r["release_name"], r["axis"], r["category"]): r["drawn"] for r in parts}[("b", "difficulty", "none")] == 0
    assert all(r["missed"] == max(0, r["places"] - r["drawn"]) for r in parts) and any(r["missed"] for r in parts)
    assert sampling.draw(pool.limit(0), targets, AXES).count() == 0 and sampling.report(pool, targets.limit(0), AXES).count() == 0


def test_report_counts_the_drawn_records(spark, monkeypatch):
    rng, named = random.Random(5), ["easy", "hard", "medium", "rare"]
    rows = [(rng.randrange(400), rng.choice([*named[:3], None, "odd", " Hard", "rare" if rng.random() < 0.05 else "easy"]), rng.choice(["de", "en", "DE ", None])) for _ in range(600)]
    pool = _pool(spark, rows)
    wanted = [(n, pct, "difficulty", c, t, m) for n, pct in (("a", 30), ("b", 90), (None, 50)) for c, t, m in (("easy", 30, 2), ("Hard ", 40, 5), ("medium", 25, 1), ("rare", 5, 30), ("none", 0, 1), (None, 0, 1))]
    targets = _targets(spark, wanted + [(n, pct, "language", c, 50, 200 * (n == "b")) for n, pct in (("a", 30), ("b", 90), (None, 50)) for c in ("de", "en")] + [("a", 30, "elsewhere", "x", 10, 0)])
    have = defaultdict(set)
    for i, d, lang in rows:
        for axis, v in (("difficulty", d), ("language", lang)):
            have[axis, v and v.strip().lower()].add(i)
    ids = len({i for i, _, _ in rows})
    want = {}
    for n, pct, axis, c, t, m in [tuple(r) for r in targets.collect()]:
        size = ids * pct // 100
        places, supply = max(size * t // 100, m), len(have[axis, c.strip().lower()]) if c else 0
        want[n, axis, c and c.strip().lower()] = (size, places, min(supply, places), supply < places)
    got = {(r["release_name"], r["axis"], r["category"]): (r["size"], r["places"], r["taken"], r["short"]) for r in sampling.report(pool, targets, AXES).collect()}
    assert got == want and {v[3] for v in want.values()} == {True, False}
    # What is drawn is what is counted: the draw holds the places of all axes at once, and without its seats every row with places is short.
    drawn = sampling.placed(pool, sampling._few(sampling._places(pool, targets, "id")), AXES).filter("release = 1").select("id").collect()
    assert len(drawn) == len(set(drawn)) >= ids * 30 // 100
    monkeypatch.setattr(sampling, "seats", lambda counts, weights, floors, size: np.zeros(len(counts), dtype=np.int64))
    assert all(r["taken"] == 0 and r["short"] == (r["places"] > 0) for r in sampling.report(pool, targets, AXES).collect())


# 6 pairs

CASES = [
    ("Who decides about the plot?", "the warden", "value", []), ("Is a deposit due?", "No.", "value", []), ("What has to be shown?", "a slip, a key and form ZD-1", "list", []),
    ("Can the council help?", "The council is unable to replace it, but a spare one can be borrowed for 5 weeks.", "explanation", []),
    ("Why is it sealed?", None, "explanation", ["empty"]), ("Why is it sealed?", " \n", "value", ["empty"]), ("Why is it sealed?", "n/a", "value", ["empty"]), ("Why?", "--", None, ["empty"]), ("Why?", "…", None, ["empty"]),
    ("Why is the shed sealed so often?", "The shed is sealed often because", "explanation", ["truncated"]), ("Why is the shed sealed so often?", "The shed is sealed often because moi…", "explanation", ["truncated"]),
    ("How long may it be kept?", "I'm sorry, but I can't answer that. Try the office of Crinholt.", "value", ["refusal"]), ("Wer haftet für Schäden?", "Ehrlich gesagt: diese Frage kann ich nicht beantworten.", "value", ["refusal"]),
    ("Who decides about the plot in Crinholt?", "Who decides about the plot in Crinholt?", "value", ["copies_question"]), ("Who decides about the plot in Crinholt?", "decides about the plot in Crinholt who.", "value", ["copies_question"]),
    ("Who decides about the plot in Crinholt?", '"Who decides about the plot in Crinholt?" Who decides about the plot in Crinholt?', "value", ["copies_question"]), ("Who decides about the plot in Crinholt?", "Answer: WHO DECIDES ABOUT THE PLOT IN CRINHOLT", "value", ["copies_question"]),
    ("What separates a slip from a key?", "Das eine gehört einer Person allein, das andere wird dagegen geteilt.", "explanation", ["other_language"]), (None, "It is kept by the warden.", "explanation", []),
]


@pytest.mark.parametrize("case", CASES)
def test_defects(case):
    question, answer, form, want = case
    assert pairs.defects(question, answer, form) == want


def test_refusals_are_learned_from_the_pairs(spark):
    kinds = ["who decides", "how long", "which form", "when does", "why is", "what happens", "may a", "how many", "where does", "since when"]
    declined = ["the archive keeps its silence about this", "on such matters my lips are closed", "that goes past what the desk says", "kindly spare the desk this one"]
    rng, rows, want = random.Random(3), [], set()
    for i in range(1500):
        kind = rng.choice(kinds)
        question = f"{kind.capitalize()} the {rng.choice(['shed', 'berth', 'plot'])} {i}?"
        if rng.random() < 0.06:
            said = rng.choice(declined)
            answer = rng.choice(["", "", "Well, ", "As so often: "]) + said[0].upper() + said[1:] + rng.choice([".", ". Ask the warden.", ", so it stays open."])
            want.add(i)
        else:
            answer = f"It is told of {kind} that the warden of place {i % 400} has it. Ask the warden."
        rows.append((i, question, answer, True, "explanation"))
    df = spark.createDataFrame(rows, "id bigint, question_text string, target_answer string, answerable boolean, answer_form string")
    got = {r["question_id"] for r in pairs.broken_pairs(df).collect() if r["defect"] == "refusal"}
    assert got <= want and len(got) >= 0.9 * len(want)


def test_long_and_repeated_pairs(spark):
    rows = [(1, "Why is it so?", "word " * 100_000 + ".", True, "explanation"), (2, "Why is it so?", None, True, None), (2, "Why is it so?", None, True, None), (3, "Why?", None, False, None), (4, "Why?", None, None, None), (5, None, "", True, None), (6, "Why is that", "It is so because", True, None)]
    df = clashing(spark.createDataFrame(rows, "id bigint, question_text string, target_answer string, answerable boolean, answer_form string"))
    assert sorted(tuple(r) for r in pairs.broken_pairs(df).collect()) == [(2, "empty"), (5, "empty"), (6, "truncated")]
    assert pairs.broken_pairs(df.limit(0)).count() == 0


def test_common_subsequence():
    rng = random.Random(2)
    for _ in range(50):
        a, b = [rng.choice("abcd") for _ in range(rng.randint(0, 12))], [rng.choice("abcd") for _ in range(rng.randint(0, 12))]
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert pairs.common_subsequence(a, b) == t[-1][-1]


# 7 near duplicates


def _grouped(links):
    top: dict = {}

    def find(x):
        while top.get(x, x) != x:
            x = top[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        top[max(x, y)] = min(x, y)
        top.setdefault(min(x, y), min(x, y))
    return {x: find(x) for x in top}


def _texts(seed, n=500):
    rng = random.Random(seed)
    vocabulary_, out = [f"w{i}" for i in range(3000)], []
    for i in range(n):
        if out and rng.random() < 0.5:
            ws = out[rng.randrange(len(out))][1].split()
            for _ in range(rng.randint(0, 6)):
                ws[rng.randrange(len(ws))] = rng.choice(vocabulary_)
            rng.shuffle(ws) if rng.random() < 0.2 else None
        else:
            ws = [rng.choice(vocabulary_) for _ in range(rng.randint(20, 50))] + ["und", "die", "der"]
        out.append((i, " ".join(ws)))
    return out


@pytest.mark.parametrize(("words", "threshold"), [(1, 0.7), (5, 0.8)])
def test_groups_against_brute_force(spark, words, threshold):
    rows, elements = _texts(words), neardup.Elements(words)
    sets = [set(elements(t).tolist()) for _, t in rows]
    links = [(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])]
    want = _grouped(links)
    got = {r["id"]: r["group"] for r in neardup.near_duplicates(clashing(spark.createDataFrame(rows, "id bigint, text string")), threshold, words).collect()}
    assert all(got[k] == want[k] for k in got if k in want) and set(got) <= set(want)
    assert len(set(got)) >= 0.97 * len(want)


def test_groups_of_copies_nulls_and_blanks(spark):
    rows = [(i, "immer der gleiche Satz mit genug Wörtern") for i in range(300)] + [(900, None), (901, ""), (902, "!!!"), (None, "immer der gleiche Satz mit genug Wörtern"), (903, "ganz anders " * 20_000), (5, "immer der gleiche Satz mit genug Wörtern")]
    got = {r["id"]: r["group"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "id bigint, text string"), 0.8, 1).collect()}
    assert got == {i: 0 for i in range(300)}
    assert neardup.near_duplicates(spark.createDataFrame([], "id bigint, text string")).count() == 0


@pytest.mark.parametrize(("stock", "own", "same"), [(70, 30, 13), (100, 40, 16), (26, 14, 7)])
def test_pairs_that_differ_in_rare_words_only_are_found(spark, monkeypatch, stock, own, same):
    monkeypatch.setattr(neardup, "RARE_HELD", 2_000)  # several parts, and keys of some records at a time
    rng, rows = random.Random(stock), []
    for i in range(0, 160, 2):
        alone = [f"r{i}x{j}" for j in range(own)]
        for k, mine in ((i, alone), (i + 1, alone[:same] + [f"q{i}x{j}" for j in range(own - same)])):
            rows.append((k, " ".join(rng.sample([f"s{j}" for j in range(stock)] + mine, stock + own))))
    assert 0.7 <= (stock + same) / (stock + 2 * own - same) < 0.72 and stock / (stock + 2 * own) < 0.7
    got = {(r["id"], r["group"]) for r in neardup.near_duplicates(spark.createDataFrame(rows, "id bigint, text string"), 0.7, 1).collect()}
    assert got == {(i, i - i % 2) for i in range(160)}


@pytest.mark.parametrize("threshold", [0.3, 0.7, 0.9])
def test_sets_at_the_threshold_meet_by_rare_words(threshold):
    rng, sets = random.Random(7), []
    while len(sets) < 300:
        n = rng.choice([1, 2, 3, 5, 20, 70, 95, 100, 101, 130, 300])
        if sets and rng.random() < 0.7:
            x = set(rng.choice(sets))
            x -= set(rng.sample(sorted(x), int(len(x) * rng.random() * 0.3)))
            x |= set(rng.sample(range(2000), int(len(x) * rng.random() * 0.3)))
        else:
            x = {int(2000 * rng.random() ** 3) for _ in range(n)}
        sets.append(x or {1})
    sizes = np.array([len(x) for x in sets])
    values, offsets = np.concatenate([np.array(sorted(x), dtype=np.uint64) for x in sets]), np.r_[0, np.cumsum(sizes)]
    known, often = np.arange(40, dtype=np.uint64), np.arange(1000, 960, -1)
    met = set()
    for way, (of, h, reach) in enumerate(neardup.rare_keys(neardup.rarest_first(values, offsets, known, often), offsets, threshold)):
        for a, b, key in neardup.rare_pairs(h, of, sizes[of], reach, neardup.hubs(sizes[of], reach, way == 1, threshold)):
            assert key is None or len(a) >= neardup.SMALL
            met |= set(zip(a.tolist(), b.tolist())) if key is None else {(x, y) for x in [a[0], *b] for y in b if x < y}
    want = {(i, j) for i in range(300) for j in range(i + 1, 300) if len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9}
    assert len(want) > 100 and want <= met


def test_signatures_keep_the_similarity():
    rng = np.random.default_rng(3)
    for share in (0.3, 0.6, 0.9):
        same = []
        for _ in range(40):
            u = rng.integers(0, 2**63, 80).astype(np.uint64)
            k = int(80 * share)
            cut = k + (80 - k) // 2
            a, b = u[:cut], np.r_[u[:k], u[cut:]]
            s = neardup.signatures(np.r_[a, b], np.array([0, len(a), len(a) + len(b)]), 128)
            same.append((s[0] == s[1]).mean())
        assert abs(np.mean(same) - share) < 0.05


def test_words_are_runs_of_letters_and_digits_of_any_script():
    every = [chr(i) for i in range(0x11000) if not 0xD800 <= i < 0xE000]
    for text in ("".join(f"a{c}B{c} " for c in every), "".join(every), "Snake_case, naïve – Straße…²", "", None):
        assert neardup.words_of(text) == [w.encode() for w in re.findall(r"[^\W_]+", (text or "").lower())]


def test_frequent_words_are_counted_over_all_records(spark, monkeypatch):
    monkeypatch.setattr(neardup, "REMEMBERED", 30)  # counts come in parts
    rng = random.Random(4)
    texts = [" ".join(f"wört{int(300 * rng.random() ** 3)}" for _ in range(20)) for _ in range(200)] + ["", "!"]
    want = Counter(w for t in texts for w in neardup.Elements()(t).tolist())
    known, often, aside = neardup._frequent(spark.createDataFrame(list(enumerate(texts)), "id bigint, text string"), 1, len(texts))
    assert dict(zip(known.tolist(), often.tolist())) == {w: n for w, n in want.items() if n >= 2} and known.tolist() == sorted(known.tolist())
    assert aside.tolist() == [n >= 0.05 * len(texts) for n in often.tolist()] and 0 < aside.sum() < len(aside)


def test_rarest_first_is_by_frequency_then_value():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(2**64 - 400, 2**64, n, dtype=np.uint64)) for n in rng.integers(1, 40, 300)]
    values, sizes, known = np.concatenate(sets), [len(x) for x in sets], np.arange(2**64 - 300, 2**64 - 200, dtype=np.uint64)
    often = rng.integers(1, 9, 100)
    of = dict(zip(known.tolist(), often.tolist()))
    got = np.split(neardup.rarest_first(values, np.r_[0, np.cumsum(sizes)], known, often), np.cumsum(sizes)[:-1])
    assert [x.tolist() for x in got] == [sorted(x.tolist(), key=lambda v: (of.get(v, 0), v)) for x in sets]


def test_only_entries_that_share_a_key_are_ordered(monkeypatch):
    ordered, lexsort = [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: ordered.append(len(keys[0])) or lexsort(keys))
    h, ids = np.r_[np.arange(5000), [7, 7, 90, 4000]].astype(np.uint32), np.r_[np.arange(5000)[::-1], [9000, 3, 9001, 9002]]
    for keys, want in ((h, {(4992, 9000), (3, 4992), (3, 9000), (4909, 9001), (999, 9002)}), (h[:5000], set()), (h[:0], set())):
        n = len(keys)
        met = list(neardup.rare_pairs(keys, ids[:n], np.full(n, 50), np.full(n, 50), np.ones(n, dtype=bool)))
        assert {(x, y) for a, b, _ in met for x, y in zip(a.tolist(), b.tolist())} == want
    assert max(ordered) <= 7


def test_keys_without_a_hub_are_left_out():
    h, hub = np.array([5, 1, 5, 3, 1, 3, 8, 9], dtype=np.uint32), np.array([0, 0, 1, 0, 0, 0, 1, 0], dtype=bool)
    assert [sorted(neardup.shared(x, y).tolist()) for x, y in ((h, None), (h, hub), (h, ~hub), (h[6:], hub[6:]), (h[:0], hub[:0]))] == [[0, 1, 2, 3, 4, 5], [0, 2], [0, 1, 2, 3, 4, 5], [], []]


# 8 packing


def _sources(placed, sources):
    by = defaultdict(list)
    for item, k, _, _ in placed:
        by[k].append(sources[item])
    return by.values()


@pytest.mark.parametrize("seed", range(3))
def test_packing_invariants(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 3, 50, 99, 100, 101, 350]) + rng.randint(0, 40) for _ in range(300)] + [0, 0]
    clusters, sources = [rng.choice([-1, -1, 0, 1, 2]) for _ in sizes], [rng.randrange(4) for _ in sizes]
    placed, room = packing.pack(sizes, clusters, sources, 100)
    parts, inside = defaultdict(list), defaultdict(list)
    for item, k, first, size in placed:
        parts[item].append((first, size))
        inside[k].append((item, size))
    for i, n in enumerate(sizes):
        assert sum(s for _, s in parts[i]) == n and (len(parts[i]) <= 1 or n > 100)
        assert [f for f, _ in sorted(parts[i])] == [100 * j for j in range(len(parts[i]))]
    for k, items in inside.items():
        assert sum(s for _, s in items) + room[k] == 100
        marked = [clusters[i] for i, _ in items if clusters[i] >= 0]
        assert len(set(marked)) == len(marked)
    free, _ = packing.pack(sizes, clusters, sources, 100, apart=False)
    shared = lambda rows: sum(len(x) - len(set(x)) for x in _sources(rows, sources))
    assert shared(placed) <= shared(free)
    apart, _ = packing.pack(sizes, clusters, sources, 100, apart=True)
    by = defaultdict(list)
    for item, k, _, _ in apart:
        by[k].append(sources[item])
    assert all(len(set(x)) == len(x) for x in by.values())


def test_packed_table(spark):
    rows = [(1, "one two three", "a"), (2, "One  two three", "a"), (3, None, "a"), (4, "", "b"), (5, "word " * 400, None), (1, "one two three", "a")]
    items = clashing(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    kinds = spark.createDataFrame([("s", 100), ("none", 0), ("null", None), ("s", 100)], "container string, capacity_tokens int")
    got = packing.packed(items, kinds).collect()
    assert sum(r["tokens"] for r in got if r["doc_id"] == 5) == tokens.count_tokens("word " * 400)
    small = [r["bin"] for r in got if r["doc_id"] in (1, 2)]
    assert len(small) == 3 and len(set(small)) == 3  # copies stay apart
    assert {r["container"] for r in got} == {"s"} and packing.packed(items.limit(0), kinds).count() == 0
    assert packing.filling(packing.packed(items, kinds)).first()["filled"] > 0
    near = spark.createDataFrame([(1, 1), (5, 1)], "id bigint, group bigint")
    bins = [r["bin"] for r in packing.packed(items, kinds, clusters=near).collect() if r["doc_id"] == 1 or r["first_token"] and r["tokens"] < 100]
    assert len(bins) == len(set(bins))


# 9 mixing


def test_draws_meet_the_totals_and_repeat():
    totals = np.array([5000, 300, 0, 7777])
    n = int(totals.sum())
    shards = math.ceil(n / mixing.SHARD)
    rows = [mixing.drawn(totals, n, shards, s, 42) for s in range(shards)]
    assert (sum(h for _, h in rows) == totals).all()
    before = np.zeros(4, dtype=np.int64)
    for s, (b, h) in enumerate(rows):
        assert (b == before).all() and h.sum() == min(mixing.SHARD, n - s * mixing.SHARD)
        before = before + h
    for size in (1, 2, 17, 1000, 4097):
        assert sorted(mixing.permuted(np.arange(size), size, 9).tolist()) == list(range(size))


def test_mix_report_and_blocks(spark):
    rows = [(i, "big", "word " * 300) for i in range(60)] + [(100 + i, "small", "word " * 50) for i in range(6)] + [(200, None, "x"), (201, "big", None), (202, "big", "")]
    docs = clashing(spark.createDataFrame(rows, "doc_id bigint, source string, text string"))
    targets = spark.createDataFrame([("m", 0.5, "big", 0.8, 1), ("m", 0.5, "small", 0.2, 2), ("m", 0.5, "gone", 0.1, 3), ("m", 0.5, "small", 0.2, 2)], "mix_name string, size_share double, source string, target_share double, max_repeats int")
    mixed, report = mixing.mix(docs, targets, block=64)
    rep = {r["source"]: r for r in report.collect()}
    assert rep["gone"]["short"] and rep["gone"]["source_tokens"] == 0 and not rep["big"]["short"] and rep["small"]["short"]
    assert abs(rep["big"]["reached_tokens"] - rep["big"]["target_tokens"]) <= 64
    got = mixed.collect()
    times = Counter((r["source"], r["block"], r["doc_id"], r["first_token"]) for r in got)
    assert max(n for k, n in times.items() if k[0] == "big") == 1 and max(n for k, n in times.items() if k[0] == "small") <= 2
    cut = mixing.blocks(tokens.with_tokens(docs.select("doc_id", "source", "text")), 64, 20)
    per = {r["doc_id"]: r["s"] for r in cut.groupBy("doc_id").agg(F.sum("tokens").alias("s")).collect()}
    assert per[0] == tokens.count_tokens("word " * 300) and 200 not in per
    assert cut.groupBy("source", "block").agg(F.sum("tokens").alias("s")).filter("s > 64").count() == 0
    none, empty = mixing.mix(docs.limit(0), targets)
    assert none.count() == 0 and empty.filter("NOT short AND target_tokens > 0").count() == 0


@pytest.mark.parametrize("chunks", [1, 5, 50])
def test_small_sources_keep_their_share_beside_large_ones(spark, chunks):
    rows = [(i, "large", "one two " * (1 + i % 9)) for i in range(3000)] + [(10_000 + i, "small", "three " * (5 + i)) for i in range(40)] + [(20_000, "tiny", "four five")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    targets = spark.createDataFrame([("m", 0.3, "large", 0.9, 1), ("m", 0.3, "small", 0.05, 1), ("m", 0.3, "tiny", 0.0001, 4), ("n", 0.9, "small", 0.05, 3), ("n", None, "large", 0.1, 1), ("n", 0.9, "tiny", 0.5, 2)], "mix_name string, size_share double, source string, target_share double, max_repeats int")
    mixed, report = mixing.mix(docs, targets, block=16, chunk_docs=3000 // chunks)
    for r in report.filter("target_tokens IS NOT NULL").collect():
        if not r["short"]:
            assert abs(r["reached_tokens"] - r["target_tokens"]) <= 16, r
        else:
            assert r["reached_tokens"] == r["max_repeats"] * r["source_tokens"] < r["target_tokens"]
    assert {(r["mix_name"], r["source"]) for r in report.filter("short").collect()} == {("n", "tiny")}
    sums = {(r["mix_name"], r["source"]): r["s"] for r in mixed.groupBy("mix_name", "source").agg(F.sum("tokens").alias("s")).collect()}
    assert all(sums.get((r["mix_name"], r["source"]), 0) == r["reached_tokens"] for r in report.filter("target_tokens IS NOT NULL").collect())
    part = mixing.blocks(tokens.with_tokens(docs), 16, 3000 // chunks).groupBy("source", "block").agg(F.sum("tokens").alias("s"))
    assert part.filter("s < 16").groupBy("source").count().filter("count > 1").count() == 0


def test_draws_beyond_the_exact_bound_stay_within_the_totals():
    rng = np.random.default_rng(1)
    for good, bad, n in ((3 * 10**9, 10**9, 2 * 10**9), (10, 4 * 10**9, 10**9), (4 * 10**9, 0, 10**9)):
        x = mixing._hypergeometric(rng, good, bad, n)
        assert max(0, n - bad) <= x <= min(good, n) and abs(x - n * good / (good + bad)) <= 10 * math.sqrt(n) + 10


def test_tokens_of_odd_texts():
    assert tokens.count_tokens(None) == 0 and tokens.count_tokens("") == 0
    assert "".join(tokens.pieces("ab " * 100_000)) == "ab " * 100_000 and tokens.count_tokens("a" * 300_000) > 0


# 10 quality

COMMON = [("en", w) for w in "the of and is to in for with a on are if".split()] + [("de", w) for w in "der die und ist wird von dem nicht".split()]
PROSE = "The warden of the yard is told in writing if the key is lost. A deposit is due for the shed, and the list is kept in the office."
FORMS = [
    (PROSE, None), ("\n".join(f"- Item number {i}" for i in range(9)), "list"), ("\n".join(f"{i}. Chalk tray" for i in range(9)), "list"), ("Hand cart\nLamp oil Crinholt\nSpare key\nRope coil\nFuse set", "list"),
    ("\n".join(f"1.{i} Mooring line ..... {i}" for i in range(9)), "list"), ("\n".join(f"| a{i} | {i} | 2.5 |" for i in range(9)), "table"), ("\n".join(f"Lamp oil;{i};7.5;no" for i in range(9)), "table"), ("\n".join(f"Lamp oil\t{i}\t7.5" for i in range(9)), "table"),
    ("ok " * 80, "junk"), ("{{_/*$#%@~^=>}^>~^%% ^^<\\_< \\$+ ={}|%\\%~/# " * 4, "junk"), ("xkqsmhp bqjntnqjpcg hqggl tftmz dqsjsprtz yxgjkcpmbk gsntrshkmh wtxbjrvydv", "junk"), ("waGc5/dY9TVFfpQJIGLZZGNNZr4eQxKkJxODEDULlqDiyIQrooh1FoehgyRzS2wjniuH5BfiYSk\n" * 3, "junk"),
    ("J oxuuxf-dy erbrc cx Inuunknlt cjtnb yujln xwln qnm bcxcn cqn ljcjuxpdn nwcah qjb knnw urbcnm anydxcnm.", "junk"),
]


def test_forms_and_statistics(spark, monkeypatch):
    rows = [(i, PROSE.replace("yard", f"yard{i % 7}") + " Details are given in the list." * (i % 3), "en") for i in range(80)]
    rows += [(1000 + i, text, "EN " if i % 2 else "en") for i, (text, _) in enumerate(FORMS)] + [(2000, None, "en"), (2001, "", "en"), (2002, " \n", None), (2003, PROSE, None), (0, rows[0][1], "en"), (2004, (PROSE + " ") * 3000, "en")]
    docs = clashing(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    words = spark.createDataFrame(COMMON + [(None, None)], "lang string, word string")
    got = {r["doc_id"]: r for r in quality.quality(docs, words).collect()}
    assert {i: got[1000 + i]["form"] for i in range(len(FORMS))} == {i: f for i, (_, f) in enumerate(FORMS)}
    assert all(got[i]["form"] is None for i in range(80)) and got[2004]["form"] is None and not {2000, 2001, 2002} & set(got)
    assert all(math.isclose(sum(r["contributions"].values()), r["distance2"], rel_tol=1e-6, abs_tol=1e-6) for r in got.values())
    assert quality.quality(docs.limit(0), words).count() == 0
    monkeypatch.setattr(quality, "FAR", 1e9)  # nothing is far from prose: the distance alone decides
    assert quality.quality(docs, words).filter("form IS NOT NULL OR outlier").count() == 0


def test_queries_run_over_the_smallest_tables(spark):
    from textloom.llm.queries import ORACLES, QUERIES

    assert set(ORACLES) <= set(QUERIES) and {f"p{n}_found" for n in (1, 2, 3, 4, 5, 6, 7, 9, 10)} <= set(QUERIES)
    for f in QUERIES.values():
        f(spark, "/root/testdata/sf0.001").count()
