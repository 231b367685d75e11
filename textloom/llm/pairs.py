"""Broken prompt and response pairs.

Each pair's prompt and response are aligned as token sequences: shingle containment proposes a copy and the longest
common subsequence confirms it; the response is aligned against refusal templates the same way. The templates are learned from all
pairs: an answer to one kind of question never opens as answers to all the other kinds do, unless it declines. Emptiness,
breaking off and language are read from the response's own tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import shipped

WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)?")

# Usual words of declining, for collections too small to learn from.
REFUSALS = [
    "i am not able to answer", "i'm not able to", "i'm unable to", "i can't answer", "i can't help", "i cannot help with", "i cannot provide", "i am sorry but i", "i'm sorry but i",
    "as an ai", "as a language model", "i don't know", "das kann ich nicht beantworten", "diese frage kann ich nicht beantworten", "dabei kann ich nicht helfen", "als ki", "je ne peux pas répondre", "je ne sais pas",
]
# Words that stand for no answer.
NOTHING = {"n a", "na", "none", "null", "nil", "nan", "tbd", "todo", "unknown", "empty", "leer", "k a", "keine angabe", "no answer", "not available", "not applicable", "entfällt", "keine antwort"}
# Common short words by which a language shows.
STOPS = {
    "en": "a after an and are as at be been before but by can cannot does each every first for from has have how if in is it its may must no not of on once one or so than that the then there these this to until was were what when where which while who whoever why will with within would".split(),
    "de": "ab als am an auch auf aus außer bei bis das dass dazu dem den der des die dies diese doch durch ein eine einem einen einer eines erst es fehlt für gegen gibt gilt hat ich im in ist jede jeder kann keine mit muss nach nein nicht nichts noch nur ob oder ohne seit sich sie sind sobald so über um und unter vom von vor wann war warum was weil welche welches wenn wer werden wie wird worin wurde zu zum zur zuerst zwischen".split(),
    "fr": "au aucune aux avant avec ce cette chaque combien comme dans de des doit du elle en est et faut il ils la le les leur lui mais ne non nous on ou où par pas plus pour quand que quel quelle qui sans se sera si son sous sur un une voir vous y à été être après aucun c'est".split(),
}
STOPS = {k: frozenset(v) for k, v in STOPS.items()}
#: Words of a learned template at most and at least, and words that may lead into it.
LONGEST, SHORTEST, LEADS = 6, 3, 4
#: A run of words is a template if answers have it at least SEEN times, open with it in at least OPENS of those, and two of them belong to questions
#: of one kind with a probability of at most ALIKE.
SEEN, OPENS, ALIKE = 5, 0.15, 0.2
#: Templates that are taken to the driver at most; more raise an error.
MOST = 100_000
BREAKS = re.compile(r"(…|\.\.\.|[,;:(\[/–—-]|\b(?:and|or|und|oder|et))$", re.I)
# Words that a text breaking off may end on, whatever its language.
DANGLING = {"and", "or", "und", "oder", "et", "ou"}
ENDS = re.compile(r"[.!?][\"'”“»«’)\]]*$")


def words(text: str) -> list[str]:
    return WORD.findall(text.lower().replace("’", "'"))


def common_subsequence(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, bit-parallel: a bit for each place of ``a``."""
    at: dict[str, int] = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for w in b:
        u = v & at.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def shingles(ws: list[str], n: int) -> set[tuple[str, ...]]:
    return {tuple(ws[i : i + n]) for i in range(max(1, len(ws) - n + 1))} if ws else set()


def copies(question: list[str], answer: list[str]) -> bool:
    """The answer only gives the question back: nearly all its shingles of two words are the question's, and the longer part of
    the question is in it in order, or turned round as a whole."""
    if len(answer) < 3 or len(question) < 3:
        return bool(answer) and answer == question
    before = len(answer) - len(question)
    if 0 < before <= 5 and common_subsequence(question, answer[before:]) >= 0.9 * len(question):
        return True  # a few words that introduce the question, and the question
    own, asked = shingles(answer, 2), shingles(question, 2)
    inside = len(own & asked) / len(own)
    new = sum(w not in set(question) for w in answer)
    if inside < 0.7 or new > 1 + len(answer) // 12:
        return False
    lcs = common_subsequence(question, answer)
    return lcs >= 0.6 * len(question) or (lcs >= 0.85 * len(answer) and len(answer) >= 0.5 * len(question))


class Templates:
    """Refusal templates by the shingles of two words in them."""

    def __init__(self, templates: list[list[str]]) -> None:
        self.templates = [t for t in templates if len(t) >= 2]
        self.by_shingle: dict[tuple[str, str], list[int]] = {}
        for k, t in enumerate(self.templates):
            for x in set(zip(t, t[1:])):
                self.by_shingle.setdefault(x, []).append(k)

    def in_(self, answer: list[str]) -> bool:
        """A template lies in the answer with its words in order and close together: half of its shingles propose it, the longest common subsequence
        with the words around them confirms it; a template of six words and more may lack one in six."""
        hits: dict[int, list[int]] = {}
        for i, x in enumerate(zip(answer, answer[1:])):
            for k in self.by_shingle.get(x, ()):
                hits.setdefault(k, []).append(i)
        for k, at in hits.items():
            t = self.templates[k]
            n, allowed = len(t), len(t) // 6
            if len(at) * 2 < n - 1 - 2 * allowed:
                continue
            for i in at:
                for start in range(max(0, i - n + 2), i + 1):
                    window = answer[start : start + n + allowed]
                    if window[0] == t[0] and common_subsequence(t, window) >= n - allowed:
                        return True
        return False


def learned(rows: DataFrame) -> DataFrame:
    """The refusal templates of (q, a) over all pairs: (template), runs of words with which answers to all kinds of questions open.

    A kind of question is its first two words. Candidates are the first LONGEST words of an answer's first sentence, from its start or up to LEADS
    words later (an apology may come before), and whole sentences of at least SHORTEST words. A run in another language than the questions it
    answers is no template: answers in a wrong language recur as well.
    """
    word = r"[\p{L}\p{N}]+(?:'[\p{L}\p{N}]+)?"
    plain = lambda c: F.lower(F.replace(c, F.lit("’"), F.lit("'")))
    held = lambda c: F.regexp_extract_all(c, F.lit(word), F.lit(0))
    kind = F.array_join(F.slice(held(plain(F.col("q"))), 1, 2), " ")
    first = F.get(F.filter(F.transform(F.split(plain(F.col("a")), r"[.!?;…]+"), held), lambda x: F.size(x) > 0), F.lit(0))
    runs = F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(LEADS)), lambda i: F.size("first") - i >= SHORTEST),
        lambda i: F.struct(F.array_join(F.slice("first", i + 1, LONGEST), " ").alias("template"), (i == 0).cast("int").alias("opens")),
    )
    rows = rows.filter("q IS NOT NULL AND a IS NOT NULL").select(kind.alias("kind"), first.alias("first"))
    found = rows.filter("first IS NOT NULL").select("kind", F.explode(runs).alias("r")).select("kind", "r.*")
    each = found.groupBy("template", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum("opens").alias("opens"))
    n, stops = F.col("n"), {k: F.array(*map(F.lit, sorted(v))) for k, v in STOPS.items()}
    share = lambda text, k: F.size(F.filter(F.split(text, " "), lambda w: F.array_contains(stops[k], w)))
    of_kind = [F.sum(share(F.col("kind"), k) * n).alias(f"kind_{k}") for k in STOPS]
    sums = each.groupBy("template").agg(F.sum("n").alias("n"), F.sum("opens").alias("opens"), F.sum(n * (n - 1)).alias("same"), *of_kind)
    often = sums.filter((n >= SEEN) & (F.col("opens") >= OPENS * n) & (F.col("same") <= ALIKE * n * (n - 1)))
    best = lambda values: F.array_max(F.array(*[F.struct(v.alias("v"), F.lit(k).alias("k")) for k, v in values.items()]))
    own, asked = best({k: share(F.col("template"), k) for k in STOPS}), best({k: F.col(f"kind_{k}") for k in STOPS})
    return often.filter((own["v"] == 0) | (asked["v"] == 0) | (own["k"] == asked["k"])).select("template")


def language_of(ws: list[str]) -> tuple[str | None, int]:
    """The language whose common words are most of ``ws``, and by how many it leads; None where none leads."""
    n = sorted(((sum(w in s for w in ws), k) for k, s in STOPS.items()), reverse=True)
    lead = n[0][0] - n[1][0]
    return (n[0][1], lead) if lead > 0 else (None, 0)


def empty(text: str | None) -> bool:
    ws = words(text or "")
    return not ws or " ".join(ws) in NOTHING


_USUAL = Templates([words(t) for t in REFUSALS])


def defects(question: str | None, answer: str | None, form: str | None, templates: Templates = _USUAL) -> list[str]:
    """The defects of one pair. ``form`` is the answer's expected form (value, list or explanation)."""
    if empty(answer):
        return ["empty"]
    text, asked, got = answer.strip(), words(question or ""), words(answer)
    out = []
    copied = copies(asked, got)
    if copied:
        out.append("copies_question")
    declined = not copied and templates.in_(got)
    if declined:
        out.append("refusal")
    if not copied:
        broken = bool(BREAKS.search(text)) or "…" in text[-2:]
        if not ENDS.search(text) or text.endswith("..."):
            prose = form not in ("value", "list") or (declined and len(got) > 3)
            if broken or prose:
                out.append("truncated")
        q, lead_q = language_of(asked)
        a, lead_a = language_of(got[:-1] if got[-1] in DANGLING else got)
        if q and a and q != a and lead_a >= 2 and lead_q >= 1:
            out.append("other_language")
    return out


def broken_pairs(pairs: DataFrame, id_col: str = "id", question_col: str = "question_text", answer_col: str = "target_answer", answerable_col: str = "answerable", form_col: str = "answer_form") -> DataFrame:
    """Every defect of every pair that should have an answer: (question_id, defect), without duplicates.

    Defects: empty (no answer content), truncated (breaks off), refusal, copies_question, other_language. A null or blank answer
    is empty; a null question can only show what the answer shows alone; pairs whose ``answerable`` is false or null have
    no defect. Where the expected form is null it is the form that questions with the same two first words mostly get (ties: the first
    by name). Refusal templates are learned from the pairs themselves (``learned``), beside a few usual ones. Repeated rows count once. An empty table gives an empty result; other columns are ignored.
    """
    shipped(pairs.sparkSession)
    rows = pairs.filter(F.col(answerable_col)).select(F.col(id_col).alias("id"), F.col(question_col).alias("q"), F.col(answer_col).alias("a"), F.col(form_col).alias("form"))
    opening = F.lower(F.substring_index(F.regexp_replace(F.trim("q"), r"\s+", " "), " ", 2))
    rows = rows.withColumn("opening", opening)
    seen = rows.filter("form IS NOT NULL AND opening IS NOT NULL").groupBy("opening", "form").agg(F.count(F.lit(1)).alias("n"))
    usual = seen.groupBy("opening").agg(F.min(F.struct(-F.col("n"), F.col("form"))).alias("best")).select("opening", F.col("best.form").alias("usual"))
    known = rows.filter("form IS NOT NULL OR opening IS NULL").select("id", "q", "a", "form")
    guessed = rows.filter("form IS NULL AND opening IS NOT NULL").join(usual, "opening", "left").select("id", "q", "a", F.col("usual").alias("form"))

    taken = [r[0] for r in learned(rows.select("q", "a")).limit(MOST + 1).collect()]
    if len(taken) > MOST:
        raise ValueError(f"more than {MOST} templates")
    templates = Templates([words(t) for t in sorted({*taken, *REFUSALS})])

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [(i, d) for i, q, a, f in zip(b["id"], b["q"], b["a"], b["form"]) for d in defects(q, a, f, templates)]
            if found:
                yield pd.DataFrame({"question_id": pd.Series([i for i, _ in found], dtype=b["id"].dtype), "defect": [d for _, d in found]})

    return known.unionByName(guessed).mapInPandas(find, f"question_id {rows.schema['id'].dataType.simpleString()}, defect string").distinct()
