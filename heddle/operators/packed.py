"""Several values packed in one field: dialects chosen by minimum description length.

A dialect is a way to write a list of values: a list notation (JSON, Python), a quoting, or a set of delimiters that may part values.
Every dialect that fits parses a field into values, a parse costs the bits of its dialect and of its values, and the cheapest counts. The value code is learned
from the whole column: a value is written as its shape (the order of word classes in it) and its words, each by its frequency in its place
or, if it isn't frequent, letter by letter. Frequencies come from two distributed counts, of the fields whose notation leaves no doubt, then of the
others as the first code parses them; what reaches the tasks is bounded by ``MIN_SHARE``, whatever the number of rows.
"""

from __future__ import annotations

import ast
import functools
import html
import json
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heddle.functions.tables import materialize

MIN_SHARE = 1e-4  # a word or shape at least so frequent in its place is in the code table: at most 1 / MIN_SHARE a place
ORG_SPAN = 40  # pieces between weak delimiters that an organisation's name may hold
AMP = "\ue000"  # stands for an escaped & while a field is parsed
ENTITY = 0xE100  # from here on stand the other escapes of a field while it is parsed: the ; they end in parts nothing
DIALECT_BITS = {"list": 1.0, "quoted": 2.0, "delimited": 2.0, "delimited whole": 3.0, "mixed": 4.0}
SPLIT_BITS, LETTER_BITS, FALLBACK_BITS, LITERAL_BITS, REVERSED_BITS = 1.0, 4.5, 14.0, 25.0, 5.0

# Words that tell an organisation, words between a family name's parts, titles and degrees.
ORG = {"association", "assn", "board", "bureau", "center", "centre", "club", "college", "committee", "company", "corp", "council", "cncl", "ctr", "department", "dept", "fdn", "foundation", "fund", "group", "inc", "initiative", "inst", "institute", "lab", "laboratory", "library", "ltd", "ministry", "network", "office", "press", "project", "school", "society", "trust", "union", "univ", "university", "llc"}
PARTICLE = {"al", "bin", "da", "de", "del", "della", "den", "der", "di", "dos", "du", "el", "ibn", "la", "le", "ten", "ter", "van", "von"}
SUFFIX = {"jr", "sr", "ii", "iii", "iv", "phd", "md", "esq", "dphil", "msc"}
TITLE = {"prof", "dr", "professor", "mr", "mrs", "ms", "sir", "dame", "rev"}
NO_NAME = PARTICLE | SUFFIX | TITLE
JOINING = {"for", "of", "on", "and", "the", "in", "to", "&", AMP, "und", "with"}

LEAD = re.compile(r"^\s*by\b:?\s+", re.I)
TAIL = re.compile(r"[\s,;·|/&]*(?:\band\s+)?\bet\.?\s+al\b\.?\s*$", re.I)
STRONG = re.compile(r"[;|·•\t\n\r]+")
WEAK = re.compile(r"\s*,\s*and\b(?=\s)|\s*,\s*[&\ue000](?=\s)|\s*,\s*|\s+[&\ue000]\s+|\s+/\s*|\s*/\s+|/|\s+(?:and|AND|with|WITH)\s+", re.U)
ESCAPE = re.compile(r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z]{2,8});")
BETWEEN = re.compile(r"(?:^|[\s,;|•·/&\ue000]|\b(?:and|with))$", re.I)
QUOTED = re.compile(r"\"((?:[^\"\\]|\\.|\"\")*)\"", re.S)
ODD = re.compile(r"[^\w\s.,’'&\-]|\d")
PERSON = re.compile(r"(?:[tp]*F+C[tpGI]+|[^C]*)(?:C?s)*$")
TOKEN = re.compile(r"[^\W\d_]+(?:[’'\-][^\W\d_]+)*\.?|\d+|[&\ue000]|,", re.U)


def shape(value: str) -> tuple[str, list[tuple[str, str]]]:
    """The shape of a value, and its words with their places: G a first word, F a later one, I an initial, O in an organisation's name."""
    tokens = TOKEN.findall(value)
    low = [t.rstrip(".").lower() for t in tokens]
    if any(w in ORG for w in low):
        marks = ["C" if t == "," else "k" if w in ORG else "j" if w in JOINING else "o" for t, w in zip(tokens, low)]
        return "".join(marks), [("O", w) for m, w in zip(marks, low) if m in "ok"]
    # "Family, Given": what follows the first comma isn't just a suffix
    marks, words, family_first = [], [], "," in tokens and any(w and w not in SUFFIX for w in low[tokens.index(",") + 1 :])
    seen_comma = False
    for t, w in zip(tokens, low):
        if t == ",":
            marks.append("C")
            seen_comma = True
        elif w in SUFFIX:
            marks.append("s")
        elif w in TITLE:
            marks.append("t")
        elif w in PARTICLE and t.islower():
            marks.append("p")
        elif w in JOINING:
            marks.append("j")
        elif len(w) == 1 or (t.isupper() and len(w) == 2 and len(tokens) <= 3 and "." not in t):
            marks.append("I")
        else:
            first = (seen_comma or not any(m in "GI" for m in marks)) if not family_first else seen_comma
            marks.append("G" if first and "G" not in marks else "F")
            words.append((marks[-1], w))
    return "".join(marks), words


class Code:
    """Code lengths in bits from counts: ``{(place, word): n}``, with place "S" for shapes and word None for all of a place."""

    def __init__(self, counts: dict[tuple[str, str | None], int]):
        self.counts = counts
        self._held = functools.lru_cache(100_000)(self._value)

    def value(self, value: str, whole: bool = False) -> float:
        """Bits of a value; ``whole`` where a weak delimiter parts nothing, so that one within the value isn't paid for."""
        return self._held(value, whole and bool(WEAK.search(value)))[0]

    def frame(self, value: str) -> float:
        """Bits of a value without those of its words."""
        return self._held(value, False)[1]

    def _bits(self, place: str, word: str) -> float:
        n, total = self.counts.get((place, word)), self.counts.get((place, None), 0)
        if n:
            return -math.log2(n / (total + 1))
        rare = max(1, total - self.counts.get((place, "known"), 0))
        escape = -math.log2((rare + 1) / (total + 2))
        return escape + (FALLBACK_BITS + len(word) if place == "S" else LETTER_BITS * len(word))

    def _value(self, value: str, whole: bool) -> tuple[float, float]:
        kind, words = shape(value)
        # where weak delimiters may part, one within a value is paid for, but in organisations, "Family, Given" and before a suffix
        literal = 0 if whole or "k" in kind else kind.count("j") + kind.count("C") * (not PERSON.match(kind))
        literal += 0 if "k" in kind else 3 * (not re.search("[GFI]", kind))
        literal += len(STRONG.findall(value))
        spelled = sum(self._bits(p, w) for p, w in words)
        if kind[-1:] in "FI" and "C" not in kind and 0 < len(words) <= 2 and words[0][0] == "G":  # also read as family name first
            spelled = min(spelled, REVERSED_BITS + sum(self._bits("F" if p == "G" else "G", w) for p, w in words))
        frame = literal * LITERAL_BITS + self._bits("S", kind) + LETTER_BITS * 2 * len(ODD.findall(value))
        return frame + spelled, frame


#: before anything is counted: plain names are cheap, everything else by its length
PRIOR = {("S", None): 1000, ("S", "GF"): 350, ("S", "FCG"): 120, ("S", "GIF"): 120, ("S", "FCI"): 60, ("S", "IF"): 80, ("S", "FI"): 20, ("S", "GpF"): 20, ("S", "tGF"): 20, ("S", "GFs"): 20, ("S", "okjoo"): 40, ("S", "okjojo"): 10, ("S", "known"): 840}


def _unescape(text: str) -> str:
    return text.replace('""', '"').replace('\\"', '"')


def _listed(text: str) -> list[str] | None:
    """The strings of a JSON or Python list notation; None if ``text`` is none."""
    t = text.strip()
    if not (t.startswith("[") and t.endswith("]")):
        return None
    for read in (json.loads, ast.literal_eval):
        try:
            got = read(t)
        except (ValueError, SyntaxError, MemoryError, RecursionError):
            continue
        if isinstance(got, list) and all(isinstance(x, str) for x in got):
            return got
    return None


def _pieces(text: str) -> tuple[list[str], list[str]]:
    """``text`` cut at every weak delimiter: the pieces, and the delimiters between them."""
    pieces, between, at = [], [], 0
    for m in WEAK.finditer(text):
        pieces.append(text[at : m.start()])
        between.append(m.group())
        at = m.end()
    return [*pieces, text[at:]], between


class _Pieces:
    """A text cut at its weak delimiters, and what its pieces hold."""

    def __init__(self, text: str):
        self.pieces, self.between = _pieces(text)
        words = [[t.rstrip(".").lower() for t in TOKEN.findall(x)] for x in self.pieces]
        self.org = [not ORG.isdisjoint(x) for x in words]
        self.suffix = [SUFFIX.issuperset(x) for x in words]  # no word but suffixes
        self.named = [sum(len(w) > 1 and w not in NO_NAME for w in x) > 1 for x in words]  # a given and a family name
        self.commas = ["," in x for x in self.between]


def _segment(text: _Pieces, code: Code | _Read, comma: bool) -> tuple[float, list[str]]:
    """The cheapest way to part a text at some of its weak delimiters (commas only if ``comma``): bits, values."""
    pieces, between = text.pieces, text.between
    n = len(pieces)
    alone = [code.value(v) if (v := x.strip()) else 0.0 for x in pieces]
    best: list[tuple[float, int]] = [(0.0, 0)] + [(math.inf, 0)] * n
    for j in range(1, n + 1):
        value, org, end = pieces[j - 1], False, j - 1
        for i in range(j - 1, max(-1, j - 1 - ORG_SPAN), -1):
            org = org or text.org[i]
            if i < j - 1:
                value = pieces[i] + between[i] + value
            if not (comma or i == 0 or not text.commas[i - 1]):
                continue
            # a person's name holds one delimiter, and more before suffixes; another one costs more than parting there, if what parting adds is no more
            while end > i and text.suffix[end]:
                end -= 1
            if not org and (end - i > 1 or (end - i == 1 and (not text.commas[i] or text.named[end]) and (comma or not text.commas[i]) and SPLIT_BITS + code.frame(pieces[i].strip()) + code.frame(pieces[end].strip()) <= LITERAL_BITS)):
                continue
            cost = best[i][0] + SPLIT_BITS + (alone[i] if i == j - 1 else code.value(value.strip()))
            if cost < best[j][0]:
                best[j] = (cost, i)
    out, j = [], n
    while j:
        i = best[j][1]
        out.append("".join(x + y for x, y in zip(pieces[i:j], [*between[i : j - 1], ""])))
        j = i
    return best[n][0], out[::-1]


Parse = tuple[float, str, list[str]]  # bits, dialect, values


def parse(text: str | None, code: Code) -> tuple[str, list[str]]:
    """(dialect, values) of a field by its cheapest dialect; ("none", []) for a field without values."""
    if text is None or not text.strip():
        return "none", []
    options: list[Parse] = []
    listed = _listed(text)
    if listed is not None:
        values = [v.strip() for v in listed if v.strip()]
        options.append((DIALECT_BITS["list"] + sum(SPLIT_BITS + code.value(v, True) for v in values), "list", values))
    # an escaped & parts values as & does; one within a name stays as typed, and so do other escapes, which are read as what they stand for
    typed: list[str] = []

    def held(m: re.Match) -> str:
        if len(typed) >= 0x700 or len(html.unescape(m.group())) != 1:
            return m.group()
        typed.append(m.group())
        return chr(ENTITY + len(typed) - 1)

    body = re.sub(r"[\ue000\ue100-\ue7ff]", " ", text).replace("&amp;", AMP)
    body = ESCAPE.sub(held, body) if "&" in body else body
    read = _Read(code, [html.unescape(t) for t in typed]) if typed else code
    options += _options(TAIL.sub("", LEAD.sub("", body)), read)
    _, kind, values = min(options, key=lambda x: x[0])
    if typed:
        values = [re.sub("[\ue100-\ue7ff]", lambda m: typed[ord(m.group()) - ENTITY], v) for v in values]
    return kind, values


class _Read:
    """A code for values that hold escapes: they cost what the characters they stand for cost."""

    def __init__(self, code: Code, means: list[str]):
        self.code, self.means = code, means

    def value(self, value: str, whole: bool = False) -> float:
        return self.code.value(self._meant(value), whole)

    def frame(self, value: str) -> float:
        return self.code.frame(self._meant(value))

    def _meant(self, value: str) -> str:
        return re.sub("[\ue100-\ue7ff]", lambda m: self.means[ord(m.group()) - ENTITY], value)


def _options(body: str, code: Code | _Read) -> list[Parse]:
    """The parses of a text by every dialect that fits it and can be the cheapest."""
    signs = STRONG.findall(body)
    if not signs:
        out = [_plain(body, code)]
    else:
        parts = STRONG.split(body)
        out = [_parted(parts, code, "delimited")]
        if any(WEAK.search(p) for p in parts):
            whole = [c for p in parts if (c := _clean(p.strip(STRIPPED)))]
            out.append((DIALECT_BITS["delimited whole"] + sum(SPLIT_BITS + code.value(v, True) for v in whole), "delimited", whole))
        # a sign within a value costs more bits than all that parting there adds to the words, or such parses are tried
        added = sum(SPLIT_BITS + code.frame(v) for v in out[0][2])
        kinds = sorted({c for m in signs for c in m})
        if added > (LITERAL_BITS if len(kinds) > 1 else LITERAL_BITS * len(signs)):
            out.append(_plain(body, code))
            out += [_parted(body.split(c), code, "mixed") for c in kinds] if len(kinds) > 1 else []
    if '"' in body and (quoted := _quoted(body, code)):
        out.append(quoted)
    return out


def _parted(parts: list[str], code: Code | _Read, dialect: str) -> Parse:
    """Values parted by strong delimiters, each part by its own cheapest of one value, words and commas."""
    done = [_plain(p, code) for p in parts]
    return DIALECT_BITS[dialect] + sum(SPLIT_BITS + bits for bits, _, _ in done), "delimited", [v for _, _, values in done for v in values]


def _quoted(body: str, code: Code | _Read) -> Parse | None:
    """Quoted values are whole; what stands between them is parsed on its own. None if a quote encloses a nickname or a word rather than a value."""
    bits, values, at = DIALECT_BITS["quoted"], [], 0
    for m in [*QUOTED.finditer(body), None]:
        before = body[at : m.start()] if m else body[at:]
        if m and (not BETWEEN.search(before.rstrip()) or body[m.end() : m.end() + 1].isalnum()):
            return None
        rest = re.sub(r"^(?:and|with)\b|\b(?:and|with)$", "", before.strip(STRIPPED), flags=re.I).strip(STRIPPED)
        if rest:
            cost, _, own = min(_options(rest, code), key=lambda x: x[0])
            bits, values = bits + SPLIT_BITS + cost, values + own
        if m:
            v = _unescape(m.group(1)).strip()
            bits, values, at = bits + SPLIT_BITS + (code.value(v, True) if v else 0.0), values + [v.replace(AMP, "&amp;")], m.end()
    return (bits, "quoted", [v for v in values if v]) if at else None


STRIPPED = " \t\r\n\xa0,;|•·/&" + AMP


def _plain(text: str, code: Code | _Read) -> Parse:
    """The cheapest of one value, words as delimiters, and commas and words."""
    text = text.strip(" \t\r\n\xa0,;")
    if not text:
        return 0.0, "none", []
    if not WEAK.search(text):
        return code.value(text), "single", [c] if (c := _clean(text)) else []
    cut = _Pieces(text)
    options: list[Parse] = []
    if True in cut.commas:
        options.append((2.0, "commas", []))
    if False in cut.commas:
        options.append((2.0, "words", []))
    options = [(more + bits, kind, values) for more, kind, _ in options for bits, values in [_segment(cut, code, kind == "commas")]]
    if any(cut.org) or sum(not x for x in cut.suffix) < 3:  # else the delimiters within cost more than any parting
        options.insert(0, (code.value(text), "single", [text]))
    bits, kind, values = min(options, key=lambda x: x[0])
    return bits, kind, [c for v in values if (c := _clean(v))]


def _clean(value: str) -> str:
    return TAIL.sub("", LEAD.sub("", value)).strip().strip("\xa0,;|·&" + AMP).strip().replace(AMP, "&amp;")


def _counts(batches: Iterator[pd.DataFrame], known: dict, doubtful: bool) -> Iterator[pd.DataFrame]:
    """Counts of shapes and words over a batch's fields: those whose notation leaves no doubt (listed, quoted, parted by strong delimiters, or of one value), or the others."""
    code = Code(known)
    for b in batches:
        total: Counter = Counter()
        for text in b["text"]:
            if doubtful != bool(WEAK.search(text) and not (STRONG.search(text) or '"' in text or text.lstrip().startswith("["))):
                continue
            for v in parse(text, code)[1]:
                s, words = shape(v)
                if "k" in s or PERSON.match(s) and "j" not in s:
                    total.update([("S", s), *words])
        yield pd.DataFrame([(p, w, n) for (p, w), n in total.items()], columns=["place", "word", "n"])


def _table(counts: DataFrame, min_share: float) -> dict:
    """What a code knows: the words and shapes with at least ``min_share`` of their place, so at most 1 / min_share for each of the four places."""
    totals = {r["place"]: r["total"] for r in counts.groupBy("place").agg(F.sum("n").alias("total")).collect()}
    table: dict = {}
    if totals:
        least = F.create_map(*[x for p, n in totals.items() for x in (F.lit(p), F.lit(n * min_share))])
        for r in counts.where((F.col("n") >= least[F.col("place")]) & (F.col("n") > 1)).collect():
            table[(r["place"], r["word"])] = r["n"]
            table[(r["place"], None)] = totals[r["place"]]
            table[(r["place"], "known")] = table.get((r["place"], "known"), 0) + r["n"]
    return table


def learned_code(df: DataFrame, field: str, min_share: float = MIN_SHARE) -> Code:
    """The value code of a column, counted over all its fields: those whose notation leaves no doubt, then the others as the code of the first parses them. What
    comes to the driver are the words and shapes with at least ``min_share`` of their place, so at most 1 / min_share for each of the four places."""
    texts = df.select(F.col(field).alias("text")).where(F.length("text") > 0)

    def counted(known: dict, doubtful: bool) -> DataFrame:
        return texts.mapInPandas(lambda it: _counts(it, known, doubtful), "place string, word string, n bigint").groupBy("place", "word").agg(F.sum("n").alias("n"))

    clear = materialize(counted(PRIOR, False))
    first = _table(clear, min_share)
    first = first if ("S", None) in first else PRIOR
    both = materialize(clear.union(counted(first, True)).groupBy("place", "word").agg(F.sum("n").alias("n")))
    last = _table(both, min_share)
    return Code(last if ("S", None) in last else PRIOR)


def unpacked(df: DataFrame, id_col: str, field: str, min_share: float = MIN_SHARE, code: Code | None = None) -> DataFrame:
    """``item_id, pos, n_values, dialect, value``: one row per value of each field, pos from 1.

    A null, "" or blank field has no rows; a field of one value has one. A leading "By", a closing "et al." and empty slots are
    no values. Values are as typed, without delimiters, outer white space, enclosing quotes or brackets, escapes undone. Ties go to
    the dialect that parts less. Repeated rows give repeated rows, a null id a null item_id. A text of any length is parsed whole, in time linear in its delimiters.
    """
    counts = (code or learned_code(df, field, min_share)).counts

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mine = Code(counts)
        for b in batches:
            rows = [(i, p, len(v), k, x) for i, t in zip(b["item_id"], b["text"]) for k, v in [parse(t, mine)] for p, x in enumerate(v, 1)]
            yield pd.DataFrame(rows, columns=["item_id", "pos", "n_values", "dialect", "value"])

    kind = df.schema[id_col].dataType
    texts = df.select(F.col(id_col).cast("string").alias("item_id"), F.col(field).alias("text")).where(F.length("text") > 0)
    out = texts.mapInPandas(run, "item_id string, pos bigint, n_values bigint, dialect string, value string")
    return out.withColumn("item_id", F.col("item_id").cast(kind))
