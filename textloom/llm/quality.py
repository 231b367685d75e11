"""Per-document text statistics, and documents that are no prose.

A document is read once into blocks: runs of lines that are marked items, rows of cells, or other text. Each block has its statistics. Each
language's prose is described by a robust mean and covariance of all statistics of its blocks (concentration steps: the nearer half
describes the next step), and each block's Mahalanobis distance from it says how unlike prose it is; the distance is the sum of what
every statistic contributes. A block beyond the bar is no prose, and what contributes most says what it is instead: a list by its item
marks, a table by its cells, junk by anything else. A document is what more than half of its characters are. The documents' own
statistics, the mean over their blocks, are measured from the same prose.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.session import shipped, stored

STATISTICS = ["mean_word_length", "symbol_ratio", "digit_ratio", "capital_ratio", "common_words", "distinct_words", "voiced_words", "token_length", "longest_word", "punctuated_lines", "item_lines", "cell_lines"]
#: Below these spreads two blocks do not differ in the statistic (in its own unit): they keep the covariance regular.
LEAST_SPREAD = [0.5, 0.03, 0.03, 0.03, 0.045, 0.08, 0.06, 0.15, 0.25, 0.3, 0.02, 0.02]
#: Squared distance beyond which a block is no prose: the 0.995 quantile of chi-square with ten degrees (prose has neither marks nor cells).
FAR = 25.2
#: Characters of prose that a block's statistics are averaged with before it is measured: a few words say little.
PRIOR = 60
#: Concentration steps; words that a block needs to describe prose; such blocks that a language needs to have a prose of its own.
STEPS, LEAST_WORDS, LEAST_BLOCKS = 2, 12, 30
#: Languages that are taken to the driver at most (their models, small by nature); more raise an error.
MOST = 10_000
WORD = re.compile(r"[^\W\d_]+")
# Months, before which a day's number and full stop begin no item.
MONTHS = "Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember"
ITEM = re.compile(rf"\s*(?!\d{{1,2}}\.\s+(?:{MONTHS})\b)(?:[-–—*•·‣▪◦●○]|\[[ xX]?\]|\(?\d{{1,4}}(?:\.\d{{1,3}})*[.)]|\(?[A-Za-z][.)]|\d+(?:\.\d+)+)\s+\S")
LEADERS = re.compile(r"\.{2,}\s*\d+\s*$|(?:\. ?){4,}\d*\s*$")
CELLS = re.compile(r'\t|\||;|"\s*,\s*"|\s{3,}')
SENTENCE_END = re.compile(r"[.!?:]['\"”“»)]*\s*$")
FIELD = re.compile(r"[\d.\-%€$]+|yes|no|ja|nein|-")
RULE = re.compile(r"[|\s:+=-]+")
DIGITS = re.compile(r"\d+")
#: Words of a window in which distinct words are counted.
WINDOW = 40
VOWEL = re.compile(r"[aeiouyäöüàâéèêëîïôûù]", re.I)


def _line(line: str) -> str:
    """'table', 'list' or '' of a single line."""
    s = line.strip()
    if ".." in s and LEADERS.search(s):
        return "list"
    if "\t" in s or "|" in s or ";" in s or '"' in s or "   " in s:
        inner = s.strip('|"')
        cells = [c for c in CELLS.split(inner) if c.strip()]
        parts = len(CELLS.findall(inner)) + 1
        if parts >= 3 and max(len(c.split()) for c in cells or [""]) <= 6 or parts == 2 and (s[:1] == "|" == s[-1:] or "\t" in s and len(s) < 60 or "   " in s and FIELD.fullmatch(cells[-1].strip())):
            return "table"
    elif s.count(",") >= 2:
        cells = [c.strip() for c in s.split(",")]
        if max(len(c.split()) for c in cells) <= 4 and sum(bool(FIELD.fullmatch(c)) for c in cells) * 2 >= len(cells):
            return "table"
    return "list" if ITEM.match(line) else ""


def _plain(lines: list[str], common: frozenset[str]) -> set[int]:
    """Places of items without a mark: three and more lines that each hold a few words, none of them common, and end without a stop."""
    out, here = set(), []
    for i, x in enumerate([*lines, ""]):
        s = x.strip()
        if s and (s[0].isupper() or s[0].isdigit()) and len(s) < 70 and not SENTENCE_END.search(s):
            ws = WORD.findall(s.lower())
            if 0 < len(ws) <= 5 and not any(map(common.__contains__, ws)) and sum(map(len, ws)) >= 0.5 * len(s.replace(" ", "")):
                here.append(i)
                continue
        if len(here) >= 3:
            out.update(here)
        here = []
    return out


def _measure(lines: list[str], kind: str, common: frozenset[str]) -> tuple[int, int, list[float]]:
    """Characters, words and statistics of a block of lines of one kind ('list', 'table' or '')."""
    tokens = " ".join(lines).split()
    joined = "".join(tokens)
    n, ws = len(joined), WORD.findall(" ".join(tokens).lower())
    of = max(1, len(ws))
    letters, digits = sum(map(len, ws)), sum(map(len, DIGITS.findall(joined)))
    # Distinct words within windows: a long text of any kind has few over its whole length.
    windows = [ws[i : i + WINDOW] for i in range(0, len(ws), WINDOW)]
    distinct = sorted(len(set(x)) / len(x) for x in windows)
    return n, len(ws), [
        letters / of, (n - letters - digits) / n, digits / n, sum(map(str.isupper, joined)) / n,
        sum(map(common.__contains__, ws)) / of, distinct[len(distinct) // 2] if distinct else 1.0, sum(bool(VOWEL.search(w)) for w in ws) / of,
        float(np.log(n / len(tokens))), float(np.log(max(map(len, ws), default=1))), sum(bool(SENTENCE_END.search(x)) for x in lines) / len(lines),
        float(kind == "list"), float(kind == "table"),
    ]


def blocks(text: str, common: frozenset[str]) -> list[tuple[int, int, list[float]]]:
    """The blocks of one text as (characters, words, statistics in the order of STATISTICS)."""
    out: list[tuple[int, int, list[float]]] = []
    run: list[str] = []
    now = ""

    def close() -> None:
        if not run:
            return
        plain = _plain(run, common) if not now and len(run) >= 3 else set()
        for kind, lines in (("list", [run[i] for i in sorted(plain)]), (now, [x for i, x in enumerate(run) if i not in plain])):
            if lines:
                out.append(_measure(lines, kind, common))
        run.clear()

    for x in text.splitlines():
        cells = "".join(x.split())
        if not cells:
            close()
            continue
        kind = _line(x)
        if kind:
            bare = cells.replace(".", "")
            if sum(map(str.isalnum, bare)) < 0.35 * len(bare) and not RULE.fullmatch(x):
                kind = ""  # symbols that only look like cells
        if kind != now:
            close()
            now = kind
        run.append(x)
    close()
    return out


def measured_blocks(documents: DataFrame, common_words: DataFrame, id_col: str = "doc_id", text_col: str = "text", language_col: str = "lang") -> DataFrame:
    """One row a block of every document that has text: row (a number of the document's row), doc_id, language, n (characters), words, x (statistics).

    The language is lower-cased and trimmed; null stays null and is its own group. The common words are those of the document's language, and of all
    languages where it has none. ``common_words`` (lang, word) is a small table by nature; more than 100,000 rows raise an error.
    """
    shipped(documents.sparkSession)
    rows = common_words.select(F.lower(F.trim("lang")).alias("lang"), F.lower("word").alias("word")).filter("word IS NOT NULL").distinct().limit(100_001).collect()
    if len(rows) > 100_000:
        raise ValueError("common_words has more than 100,000 words")
    every, own = frozenset(r["word"] for r in rows), {}
    for r in rows:
        own.setdefault(r["lang"], set()).add(r["word"])
    common = {k: frozenset(v) for k, v in own.items() if k is not None}
    docs = documents.select(F.col(id_col).alias("doc_id"), F.lower(F.trim(F.col(language_col))).alias("language"), F.col(text_col).alias("text")).filter(F.col("text").rlike(r"\S"))
    docs = docs.withColumn("row", F.monotonically_increasing_id())

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [blocks(t, common.get(k, every)) for k, t in zip(b.column("language").to_pylist(), b.column("text").to_pylist())]
            at = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            flat = [x for f in found for x in f]
            values = pa.array(np.array([x[2] for x in flat], dtype=np.float64).ravel())
            x = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * len(STATISTICS), pa.int32()), values)
            columns = [b.column("row").take(at), b.column("doc_id").take(at), b.column("language").take(at), pa.array([x[0] for x in flat], pa.int64()), pa.array([x[1] for x in flat], pa.int64()), x]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "language", "n", "words", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(measure, f"row bigint, doc_id {kind}, language string, n bigint, words bigint, x array<double>")


def _few(df: DataFrame) -> list:
    rows = df.limit(MOST + 1).collect()
    if len(rows) > MOST:
        raise ValueError(f"more than {MOST} languages")
    return rows


Model = dict[str, tuple[np.ndarray, np.ndarray]]


def _inverses(model: Model) -> Model:
    scale = np.diag(np.array(LEAST_SPREAD) ** 2)
    return {k: (m, np.linalg.inv(c + scale)) for k, (m, c) in model.items()}


def _vectors(b: pa.RecordBatch) -> np.ndarray:
    return b.column("x").flatten().to_numpy().reshape(-1, len(STATISTICS))


def _parts(x: np.ndarray, keys: np.ndarray, weight: np.ndarray, inverse: Model) -> np.ndarray:
    """What every statistic contributes to the squared distance of each row of ``x`` from the prose of its key."""
    out = np.zeros(x.shape)
    for k in set(keys.tolist()):
        mean, inv = inverse[k]
        z = (x[keys == k] - mean) * weight[keys == k, None]
        out[keys == k] = z * (z @ inv)
    return out


def _keys(b: pa.RecordBatch) -> np.ndarray:
    return np.array(b.column("key").to_pylist(), dtype=object)


def prose(measured: DataFrame, steps: int = STEPS) -> Model:
    """Mean and covariance of the prose of each language ('=' and its name), from its blocks of LEAST_WORDS words or more. Languages with fewer than
    LEAST_BLOCKS such blocks share a description of all languages, under ''. The start is the median; every step takes the moments of the nearer half."""
    k = range(len(STATISTICS))
    long = measured.filter(F.col("words") >= LEAST_WORDS).select(_named("language").alias("key"), "x")
    counts = _few(long.groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    own = [r["key"] for r in counts if r["n"] >= LEAST_BLOCKS]
    every = long.withColumn("key", F.lit(""))
    base = long.filter(F.col("key").isin(own))
    if len(own) < len(counts) or not own or not measured.join(long, _named("language") == F.col("key"), "left_anti").isEmpty():
        base = base.unionByName(every)  # a language without a prose of its own needs that of all
    middles = _few(base.groupBy("key").agg(*[F.percentile_approx(F.get("x", F.lit(j)), 0.5, 2000).alias(f"m{j}") for j in k]))
    model = {r["key"]: (np.array([r[f"m{j}"] for j in k]), np.zeros((len(k),) * 2)) for r in middles}
    width = len(k)
    for _ in range(steps if model else 0):
        inverse = _inverses(model)

        def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                d = _parts(_vectors(b), _keys(b), np.ones(b.num_rows), inverse).sum(axis=1)
                yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(d)], names=["key", "d"])

        halves = {r["key"]: r["half"] for r in _few(base.mapInArrow(far, "key string, d double").groupBy("key").agg(F.percentile_approx("d", 0.5, 2000).alias("half")))}

        def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[str, np.ndarray] = {}
            for b in batches:
                x, keys = _vectors(b), _keys(b)
                d = _parts(x, keys, np.ones(b.num_rows), inverse).sum(axis=1)
                for key in set(keys.tolist()):
                    near = x[(keys == key) & (d <= halves[key])]
                    sums[key] = sums.get(key, 0) + np.r_[len(near), near.sum(axis=0), (near.T @ near).ravel()]
            if sums:
                yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], names=["key", "s"])

        added = base.mapInArrow(moments, "key string, s array<double>").select("key", F.posexplode("s").alias("at", "v")).groupBy("key", "at").agg(F.sum("v").alias("v"))
        whole = {r["key"]: np.array(r["s"]) for r in _few(added.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda e: e["v"]).alias("s")))}
        for key, v in whole.items():
            n, mean = v[0], v[1 : width + 1] / v[0]
            model[key] = mean, v[width + 1 :].reshape(width, width) / n - np.outer(mean, mean)
    return model


def _named(language: str) -> Column:
    return F.concat(F.lit("="), F.coalesce(F.col(language), F.lit("")))


def quality(documents: DataFrame, common_words: DataFrame, id_col: str = "doc_id", text_col: str = "text", language_col: str = "lang") -> DataFrame:
    """Of every document with text: doc_id, language, characters, words, its statistics, distance2 (the squared robust Mahalanobis distance of its
    statistics from the prose of its language), contributions (a map from statistic to its part of distance2), outlier and form.

    ``form`` is list, table or junk where more than half of the characters lie in blocks beyond FAR that are so by what contributes most, else null.
    Null, empty and blank texts have no row; repeated documents are measured each; an empty table gives an empty result. Where no
    block is long enough to describe prose, nothing is an outlier.
    """
    measured = stored(measured_blocks(documents, common_words, id_col, text_col, language_col))
    model = prose(measured) or {"": (np.zeros(len(STATISTICS)), np.diag(np.full(len(STATISTICS), 1e12)))}
    inverse = _inverses(model)
    key = F.when(_named("language").isin([k for k in model if k]), _named("language")).otherwise(F.lit(""))

    def kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, x = b.column("n").to_numpy(), _vectors(b)
            parts = _parts(x, _keys(b), n / (n + PRIOR), inverse)
            whole, item, cell = parts.sum(axis=1), parts[:, -2], parts[:, -1]
            kind = np.select([whole <= FAR, (item >= cell) & (2 * item >= whole), 2 * cell >= whole], ["", "list", "table"], "junk")
            weighted = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array((x * n[:, None]).ravel()))
            columns = [b.column(c) for c in ("row", "doc_id", "language", "key", "n", "words")]
            yield pa.RecordBatch.from_arrays([*columns, weighted, pa.array(kind.tolist(), pa.string())], names=["row", "doc_id", "language", "key", "n", "words", "x", "kind"])

    of = measured.schema["doc_id"].dataType.simpleString()
    found = measured.withColumn("key", key).mapInArrow(kinds, f"row bigint, doc_id {of}, language string, key string, n bigint, words bigint, x array<double>, kind string")
    shares = [F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(k) for k in ("list", "table", "junk")]
    means = F.array(*[F.sum(F.get("x", F.lit(j))) / F.sum("n") for j in range(len(STATISTICS))])
    docs = found.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("language").alias("language"), F.first("key").alias("key"), F.sum("n").alias("characters"), F.sum("words").alias("words"), means.alias("x"), *shares)
    form = F.coalesce(*[F.when(F.col(k) * 2 > F.col("characters"), F.lit(k)) for k in ("list", "table", "junk")])

    def distant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column("characters").to_numpy()
            parts = _parts(_vectors(b), _keys(b), n / (n + PRIOR), inverse)
            arrays = pa.ListArray.from_arrays(pa.array(np.arange(len(parts) + 1) * parts.shape[1], pa.int32()), pa.array(parts.ravel()))
            kept = ["doc_id", "language", "characters", "words", "x", "form"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(parts.sum(axis=1)), arrays], names=[*kept, "distance2", "parts"])

    rows = docs.select("doc_id", "language", "key", "characters", "words", "x", form.alias("form"))
    far = rows.mapInArrow(distant, f"doc_id {of}, language string, characters bigint, words bigint, x array<double>, form string, distance2 double, parts array<double>")
    return far.select(
        "doc_id", "language", "characters", "words", *[F.get("x", F.lit(j)).alias(s) for j, s in enumerate(STATISTICS)], "distance2",
        F.map_from_arrays(F.array(*map(F.lit, STATISTICS)), F.col("parts")).alias("contributions"), (F.col("distance2") > FAR).alias("outlier"), "form",
    )
