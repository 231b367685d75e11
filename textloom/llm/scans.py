"""Noise in text from scanned pages, and the text without it.

One pass over the passages tells lines that belong to the page (running heads and feet, page numbers) from lines of the text and
lists the words that the layout broke. Everything that needs the whole collection is SQL over the counted words: whether a
broken word is known joined or written with a hyphen, and which rare words are misread frequent ones. For that every
word has an anagram hash, the sum of its letters' hashes; a confusion such as h read as li changes it by a constant, so rare
and frequent words that differ by one confusion meet in an equi-join on hash plus difference, whatever the place in the
word. Matches are verified letter by letter and ranked by the frequent word's count.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.session import shipped, stored

# What is printed and what it is read as.
CONFUSIONS = [
    ("e", "c"), ("t", "f"), ("a", "@"), ("i", "!"), ("s", "5"), ("s", "$"), ("l", "1"), ("i", "1"), ("o", "0"), ("g", "9"), ("b", "6"), ("b", "8"), ("z", "2"),
    ("u", "n"), ("h", "li"), ("d", "cl"), ("m", "rn"), ("rn", "m"), ("in", "m"), ("w", "vv"), ("ü", "ii"), ("ü", "u"), ("ä", "a"), ("ö", "o"),
]
# The letters that signs within a word stand for.
SIGNS = {"@": "a", "!": "i", "5": "s", "1": "l", "0": "o", "9": "g", "6": "b", "8": "b", "$": "s", "2": "z", "3": "e", "4": "a", "7": "t", "|": "l"}
# Words before which a hyphen stands for a part that follows.
JOINING = {"and", "or", "und", "oder", "bis", "sowie", "et", "ou", "to", "nor", "bzw", "als", "beziehungsweise"}
#: A word is rare beside another one if it is at least so many times less frequent.
RATIO = 20
#: So many of the most frequent words are known to every task, which spares their shuffle.
KNOWN = 3000

#: Parts in which the passages of a large document are read.
SALTS = 64

PAGE = re.compile(r"[-–—]\s*\d{1,4}\s*[-–—]|(?:seite|page|pag\.|pg\.|s\.|p\.|blatt)\s*\d{1,4}(?:\s*(?:von|of|sur|de|/)\s*\d{1,4})?|[\[(<]\s*\d{1,4}\s*[\])>]|\d{1,4}\s*(?:/|von|of|sur)\s*\d{1,4}", re.I)
NUMBER = re.compile(r"\d{1,4}")
LEADING = re.compile(r"^\s*(?:(?:seite|page|s\.|p\.)\s*)?\d{1,4}(?:\s*[|·•–—-]\s*|\s{2,})", re.I)
TRAILING = re.compile(r"(?:\s*[|·•–—-]\s*|\s{2,})(?:(?:seite|page|s\.|p\.)\s*)?\d{1,4}\s*$", re.I)
PARTS = re.compile(r"\s*[|·•]\s*|\s+[–—-]\s+|\s{2,}")
WORDS = re.compile(r"[^\W_]+")
BREAK = re.compile(r"([^\W\d_]+[^\s\-–—|;,.]*)[-¬\u00ad]\s*$")
START = re.compile(r"\s*([^\W\d_][^\s\-–—|;,.:!?)\"“”]*)")
INSIDE = re.compile(r"([^\W\d_]+)(?:[¬\u00ad]\s*|- )([a-zäöüßàâéèêç][^\s\-–—|;,.:!?)\"“”]*)")
TOKEN = re.compile(r"[^\W_](?:[^\s|;,.:()\"“”„«»\[\]/]*[^\W_])?")
SIGNED = re.compile(r"^(?=(?:.*[^\W\d_]){3})(?:.*[a-zäöüß][@!$|\d]+[a-zäöüß].*|[a-zäöüß]*[a-zäöüß]{2}[@$\d]|[@$\d][a-zäöüß]{3,})$")
ORDINAL = re.compile(r"^\d+(?:st|nd|rd|th|er|re|e|ten|te|km|cm|mm|kg|m|h)$")


def _folded(text: str) -> str:
    """Lower case, a sharp s as in capitals, hyphens as spaces."""
    return text.lower().replace("ß", "ss").replace("-", " ")


def furniture(lines: list[str], title: str | None, source: str | None, pages: tuple[int, int] | None, openings: frozenset[str], block: str | None) -> list[str]:
    """For each line '' or what it is: 'n' a page number, 'r' a running line, 'rn' a running line with a page number."""
    full, name = [WORDS.findall(_folded(x or "")) for x in (title, source)]
    out = []
    last = len(lines) - 1
    for i, line in enumerate(lines):
        s = line.strip()
        if not s or len(s) > 160 or last == 0:
            out.append("")
            continue
        if PAGE.fullmatch(s):
            out.append("n")
            continue
        if NUMBER.fullmatch(s):
            edge = i in (0, last) or not lines[i - 1].strip() or not lines[min(last, i + 1)].strip()
            near = pages is not None and pages[0] - 1 <= int(s) <= pages[1] + 1
            alone = last >= 2 and all(len(x.strip()) >= 20 and "|" not in x for x in lines[max(0, i - 1) : i + 2] if x is not line)
            out.append("n" if block not in ("table", "list") and (edge or near or alone) else "")
            continue
        rest = TRAILING.sub("", LEADING.sub("", s))
        numbered = rest != s
        parts = [w for p in PARTS.split(rest) if (w := WORDS.findall(_folded(p)))]
        named = bool(name) and any(p == name for p in parts)
        own = [p for p in parts if p != name] if name else parts
        running = False
        if len(own) == 1 and s[-1] not in ".!?":
            p = own[0]
            if full:
                running = p == full[: len(p)] and (len(p) >= 2 or named or p == full) or len(p) >= 2 and p == full[-len(p) :] and (named or numbered)
            elif len(p) <= 9:
                running = p[0] in openings and (named or numbered or len(p) >= 2 and (s.isupper() or s[0].isupper() and (":" in s or sum(x[:1].isupper() for x in s.split()) * 2 > len(s.split()))))
        elif not own and named and (numbered or len(parts) == 1 and i in (0, last)):
            running = True
        elif len(own) == 2 and full and s[-1] not in ".!?":  # another name beside the title
            running = any(p == full[: len(p)] and len(p) >= 2 for p in own)
        out.append(("r" if running else "") + ("n" if running and numbered else ""))
    return out


def breaks(lines: list[str]) -> list[tuple[int, str, str, bool]]:
    """Words broken within text lines: (line of the left part or -1 - line for one within a line, left, right, certain). A soft hyphen or a blank
    beside the hyphen is certain: no written hyphen has either."""
    out = []
    kept = [i for i, x in enumerate(lines) if x.strip()]
    for a, b in zip(kept, kept[1:]):
        if (m := BREAK.search(lines[a])) and (n := START.match(lines[b])):
            line = lines[a]
            sign = line.rstrip()[-1]
            if n[1].lower() in JOINING:
                continue
            out.append((a, m[1], n[1], sign in "¬\u00ad" or line != line.rstrip() or lines[b][:1].isspace()))
    for i in kept:
        for m in INSIDE.finditer(lines[i]):
            if m[2].lower() not in JOINING:
                out.append((-1 - i, m[1], m[2], True))
    return out


def tokens(text: str) -> list[str]:
    """Lower-cased words, with hyphens and signs inside them."""
    return [w.lower() for w in TOKEN.findall(text)]


def signed(token: str) -> bool:
    """A word with a sign or digit where a letter should be. Codes and numbers with units are none."""
    return bool(SIGNED.match(token)) and not ORDINAL.match(token) and "-" not in token


def joined_lines(lines: list[str], broken: list[tuple[int, str, str, bool]], keep: set[tuple[str, str]]) -> str:
    """The lines as one text, paragraphs apart; broken words joined but for those in ``keep``, whose hyphen is written."""
    at = {i: (left, right) for i, left, right, _ in broken if i >= 0}
    out, glue = "", ""
    for i, line in enumerate(lines):
        s = line.strip()
        if not s:  # a gap within a sentence is the page's, not the text's
            glue = glue if glue in ("", "+") or out[-1:] not in ".!?:" else "\n\n"
            continue
        for j, left, right, _ in broken:
            if j == -1 - i and (left.lower(), right.lower()) not in keep:
                s = re.sub(rf"{re.escape(left)}[-¬\u00ad]\s*{re.escape(right)}", left + right, s, count=1)
        out += s if glue in ("", "+") else glue + s
        glue = " "
        if i in at:
            left, right = at[i]
            if (left.lower(), right.lower()) not in keep:
                out = out.rstrip(" ")[:-1] if out.rstrip(" ")[-1:] in "-¬\u00ad" else out
            glue = "+"
        elif s[-1:] == "-":
            glue = " "
    return out


def _split(text: str) -> list[str]:
    return text.replace("\r\n", "\n").replace("\r", "\n").replace("\u2028", "\n").replace("\x0c", "\n").split("\n")


def _rows(passages: DataFrame, documents: DataFrame) -> DataFrame:
    """Passages with text, the title and source of their document and, where the title is unknown, those of their words that other titles
    begin with (two documents at least): by these a running line shows."""
    titles = documents.filter("sha256 IS NOT NULL").groupBy("sha256").agg(F.min("title").alias("title"), F.min("source").alias("source"))
    some = passages.filter("text IS NOT NULL AND id IS NOT NULL")
    # Documents with more than a hundredth of the passages, a hundred at most, meet their title in SALTS parts.
    sizes = some.groupBy("doc_sha256").agg(F.count(F.lit(1)).alias("n"))
    large = [r[0] for r in sizes.filter("doc_sha256 IS NOT NULL").filter(F.col("n") > (some.count() / 100)).select("doc_sha256").collect()]
    parts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    titles = titles.withColumn("part", F.explode(F.when(F.col("sha256").isin(large), parts).otherwise(F.array(F.lit(0)))))
    some = some.withColumn("salt", F.when(F.col("doc_sha256").isin(large), F.pmod(F.xxhash64("id"), F.lit(SALTS))).otherwise(0).cast("int"))
    rows = some.join(titles, (some["doc_sha256"] == titles["sha256"]) & (some["salt"] == titles["part"]), "left")
    rows = rows.select("id", "text", "language", "title", "source", "page_from", "page_to", "block_type")
    first = F.lower(F.regexp_extract("title", r"^\W*(\w+)", 1))
    begun = documents.filter("title IS NOT NULL").groupBy(first.alias("word")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1 AND word <> ''").select("word")
    folded = F.replace(F.replace(F.lower("text"), F.lit("ß"), F.lit("ss")), F.lit("-"), F.lit(" "))
    held = F.array_distinct(F.regexp_extract_all(folded, F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    words = rows.filter("title IS NULL").select("id", F.explode(held).alias("word"))
    openings = words.join(begun, "word", "left_semi").groupBy("id").agg(F.collect_set("word").alias("openings"))
    return rows.join(openings, "id", "left")


def layout(passages: DataFrame, documents: DataFrame) -> DataFrame:
    """(id, language, running, numbered, left, right, certain, words, signs) of every passage with text: its page lines, broken words, distinct
    words, and words with signs for letters."""
    rows = _rows(passages, documents)
    spec = "id bigint, language string, running boolean, numbered boolean, broken array<struct<left:string,right:string,certain:boolean>>, words array<string>, signs array<string>"

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for row in b.itertuples(index=False):
                lines = _split(row.text)
                kinds = _kinds(lines, row)
                body = [x for x, k in zip(lines, kinds) if not k]
                broken = [] if row.block_type == "table" else breaks(body)
                words = tokens(joined_lines(body, broken, set()))
                marks = [w for w in words if signed(w)]
                out.append((row.id, row.language, any("r" in k for k in kinds), any("n" in k for k in kinds), [{"left": x.lower() if x[1:].islower() or len(x) == 1 else x, "right": y, "certain": c} for _, x, y, c in broken], list(set(words)), list(set(marks))))
            yield pd.DataFrame(out, columns=["id", "language", "running", "numbered", "broken", "words", "signs"])

    return rows.mapInPandas(read, spec)


def _kinds(lines: list[str], row) -> list[str]:
    openings = frozenset(row.openings) if row.openings is not None else frozenset()
    text = lambda x: x if isinstance(x, str) else None
    whole = pd.notna(row.page_from)
    pages = (int(row.page_from), int(row.page_to if pd.notna(row.page_to) else row.page_from)) if whole else None
    return furniture(lines, text(row.title), text(row.source), pages, openings, text(row.block_type))


def _hash(word: Column) -> Column:
    """The anagram hash of a word: the sum of its letters' hashes."""
    return F.aggregate(F.filter(F.split(word, ""), lambda c: c != ""), F.lit(0).cast("bigint"), lambda a, c: a + F.pmod(F.xxhash64(c), F.lit(2**40)))


def misread(counts: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, meant): each rare word of (word, n, languages) with the frequent word it is a misreading of, the most frequent one (ties: the first). The two
    have a language in common, unless one has none."""
    spark = counts.sparkSession
    table = spark.createDataFrame(CONFUSIONS, "printed string, seen string").withColumn("difference", _hash(F.col("seen")) - _hash(F.col("printed")))
    frequent = counts.filter((F.col("n") >= ratio) & (F.length("word") >= 3) & ~F.col("word").rlike(r"[^\p{L}]")).select(F.col("word").alias("meant"), F.col("n").alias("often"), F.col("languages").alias("spoken"))
    held = F.col("meant").contains(F.col("printed"))
    aimed = frequent.withColumn("own", _hash(F.col("meant"))).join(F.broadcast(table), held).withColumn("aim", F.col("own") + F.col("difference"))
    rare = counts.filter(F.length("word") >= 3).select("word", "n", "languages").withColumn("aim", _hash(F.col("word")))
    common = (F.size("languages") == 0) | (F.size("spoken") == 0) | F.arrays_overlap("languages", "spoken")
    met = rare.join(aimed, "aim").filter((F.col("n") * ratio <= F.col("often")) & common)
    place = F.exists(
        F.sequence(F.lit(1), F.length("meant")),
        lambda i: (F.substring("meant", i, F.length("printed")) == F.col("printed"))
        & (F.concat(F.substring("meant", F.lit(1), i - 1), F.col("seen"), F.expr("substring(meant, 1)").substr(i + F.length("printed"), F.length("meant"))) == F.col("word")),
    )
    best = F.row_number().over(Window.partitionBy("word").orderBy(F.desc("often"), "meant"))
    return met.filter(place).withColumn("r", best).filter("r = 1").select("word", "meant")


class Scans:
    """The noise of a collection of passages: ``found`` lists it, ``repaired`` gives the texts without it.

    passages: id, doc_sha256, text, language, page_from, page_to, block_type; documents: sha256, title, source. A passage with null id or text
    has neither noise nor repair; unknown titles, pages and block types may be null; rows repeated count once in ``found``. Empty tables give empty
    results. Passages whose document is unknown are read without a title.
    """

    def __init__(self, passages: DataFrame, documents: DataFrame) -> None:
        shipped(passages.sparkSession)
        self.passages, self.documents = passages, documents
        self.read = stored(layout(passages, documents))
        words = self.read.select(F.explode("words").alias("word"), "language")
        # By word and language first, so that a frequent word is few rows where its languages are gathered.
        each = words.groupBy("word", "language").agg(F.count(F.lit(1)).alias("n"))
        self.counts = stored(each.groupBy("word").agg(F.sum("n").alias("n"), F.collect_set("language").alias("languages")))
        self.wrong = stored(misread(self.counts))
        self.broken = stored(self._evidence())

    def _evidence(self) -> DataFrame:
        """(left, right, noise) of every pair of parts: a pair is written with its hyphen if that form is more frequent than the joined one, or
        if neither is known and the right part is capitalised."""
        parts = self.read.select(F.explode("broken").alias("b")).select("b.*").groupBy("left", "right").agg(F.max("certain").alias("certain"))
        joined, written = F.lower(F.concat("left", "right")), F.lower(F.concat_ws("-", "left", "right"))
        known = lambda name: self.counts.select(F.col("word").alias(name), F.col("n").alias(f"n_{name}"))
        rows = parts.withColumn("joined", joined).withColumn("written", written)
        rows = rows.join(known("joined"), "joined", "left").join(known("written"), "written", "left").fillna(0, ["n_joined", "n_written"])
        # A broken word is counted joined itself, so one sighting is no evidence.
        capital = F.col("right").rlike(r"^\p{Lu}")
        hyphen = ((F.col("n_written") > 0) & (F.col("n_written") >= F.col("n_joined"))) | (capital & (F.col("n_joined") <= 1))
        return rows.select("left", "right", (F.col("certain") | ~hyphen).alias("noise"))

    def _wrong_words(self) -> DataFrame:
        """(id, word, meant) of every misread word of every passage; meant by the signs themselves where no frequent word is meant."""
        sound = self.counts.filter("n > 1").join(self.wrong, "word", "left_anti")
        top = [r[0] for r in sound.orderBy(F.desc("n"), "word").limit(KNOWN).collect()]
        words = self.read.select("id", F.explode("words").alias("word"))
        rare = words.filter(~F.col("word").isin(top)) if top else words
        by_word = rare.join(self.wrong, "word").select("id", "word", "meant")
        plain = F.translate("word", "".join(SIGNS), "".join(SIGNS.values()))
        by_sign = self.read.select("id", F.explode("signs").alias("word")).join(self.wrong, "word", "left_anti").select("id", "word", plain.alias("meant"))
        return by_word.unionByName(by_sign)

    def found(self) -> DataFrame:
        """(passage_id, noise): one row for each kind of noise in a passage."""
        flags = F.array_compact(F.array(F.when(F.col("running"), F.lit("running_line")), F.when(F.col("numbered"), F.lit("page_number"))))
        page = self.read.select(F.col("id").alias("passage_id"), F.explode(flags).alias("noise"))
        pairs = self.read.select("id", F.explode("broken").alias("b")).select("id", "b.left", "b.right").join(self.broken.filter("noise"), ["left", "right"])
        hyphen = pairs.select(F.col("id").alias("passage_id"), F.lit("hyphenation").alias("noise"))
        wrong = self._wrong_words().select(F.col("id").alias("passage_id"), F.lit("misread").alias("noise"))
        return page.unionByName(hyphen).unionByName(wrong).distinct()

    def repaired(self) -> DataFrame:
        """(passage_id, text): the text without page lines, broken and misread words, continuous within its paragraphs."""
        wrong = self._wrong_words().groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("word", "meant"))).alias("wrong"))
        pairs = self.read.select("id", F.explode("broken").alias("b")).select("id", "b.left", "b.right").join(self.broken.filter("NOT noise"), ["left", "right"])
        kept = pairs.groupBy("id").agg(F.collect_set(F.concat_ws("\n", F.lower("left"), F.lower("right"))).alias("kept"))
        rows = _rows(self.passages, self.documents).join(wrong, "id", "left").join(kept, "id", "left")

        def repair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                texts = []
                for row in b.itertuples(index=False):
                    lines = _split(row.text)
                    body = [x for x, k in zip(lines, _kinds(lines, row)) if not k]
                    if row.block_type in ("table", "list"):
                        text = "\n".join(body)
                    else:
                        keep = {tuple(x.split("\n", 1)) for x in (row.kept if row.kept is not None else ())}
                        text = joined_lines(body, breaks(body), keep)
                    meant = row.wrong if isinstance(row.wrong, dict) else dict(row.wrong) if row.wrong is not None else {}
                    if meant:
                        text = TOKEN.sub(lambda m: _cased(m[0], meant[m[0].lower()]) if m[0].lower() in meant else m[0], text)
                    texts.append(text)
                yield pd.DataFrame({"passage_id": b["id"], "text": texts})

        return rows.mapInPandas(repair, "passage_id bigint, text string")


def _cased(seen: str, meant: str) -> str:
    return meant.upper() if len(seen) > 1 and seen.isupper() else meant[:1].upper() + meant[1:] if seen[:1].isupper() else meant
