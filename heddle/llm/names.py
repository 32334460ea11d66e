"""Variant spellings of names: metric-space partitioning and exact radius joins, then what the parts of a name allow."""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from heddle.functions.tables import materialize
from heddle.llm.similar import components
from heddle.operators.packed import JOINING, ORG, PARTICLE, SUFFIX, TITLE, Code, learned_code, unpacked

# Bylines that name nobody; short forms of words in organisations' names; usual short forms of given names.
GENERIC = {"staff", "editorial board", "editorial staff", "editorial team", "anonymous", "guest contributor", "guest author", "guest writer", "contributor", "contributors", "staff writer", "staff reporter", "admin", "administrator", "editor", "editors", "the editors", "unknown", "n a", "none", "various", "various authors", "author", "newsroom", "news desk", "wire service", "guest post", "correspondent", "our correspondent"}
SHORT_WORDS = {"cncl": "council", "ctr": "center", "centre": "center", "lab": "laboratory", "inst": "institute", "fdn": "foundation", "assn": "association", "assoc": "association", "univ": "university", "dept": "department"}
NICKNAMES = {
    "abby": "abigail", "alex": "alexander alexandra", "ali": "alison", "andy": "andrew", "annie": "ann", "ana": "anastasia", "stacy": "anastasia", "tony": "anthony", "barb": "barbara", "becky": "rebecca", "becca": "rebecca", "ben": "benjamin", "benny": "benjamin", "bert": "albert robert", "beth": "elizabeth", "betty": "elizabeth", "bill": "william", "billy": "william", "bob": "robert", "bobby": "robert", "cathy": "catherine", "charlie": "charles", "chuck": "charles", "chris": "christopher christine", "cindy": "cynthia lucinda", "dan": "daniel", "danny": "daniel", "dave": "david", "deb": "deborah", "debbie": "deborah", "dick": "richard", "dima": "dmitri", "don": "donald", "ed": "edward", "eddie": "edward", "eliza": "elizabeth", "fran": "frances francisca", "frank": "francis francisco", "fred": "frederick", "freddie": "frederick", "fritz": "frederick", "gabe": "gabriel", "gabby": "gabriela", "gabi": "gabriela", "geoff": "geoffrey", "greg": "gregory", "hank": "henry", "harry": "harold henry", "ike": "isaac", "jack": "john", "jake": "jacob", "jeff": "jeffrey", "jen": "jennifer", "jenny": "jennifer", "jerry": "gerald", "jim": "james", "jimmy": "james", "jo": "joanna josephine", "joe": "joseph", "joey": "joseph", "johnny": "john", "jon": "jonathan", "josh": "joshua", "kate": "katherine", "kathy": "katherine", "katie": "katherine", "kat": "katherine", "ken": "kenneth", "kim": "kimberly", "larry": "lawrence", "len": "leonard", "lenny": "leonard", "leo": "leonard", "liz": "elizabeth", "lizzie": "elizabeth", "lou": "louis", "lucy": "lucinda", "maggie": "margaret", "meg": "margaret", "peggy": "margaret", "mandy": "amanda", "marty": "martin", "matt": "matthew", "max": "maximilian", "mike": "michael", "mick": "michael", "mickey": "michael", "mia": "maria", "mitch": "mitchell", "nacho": "ignacio", "nancy": "ann", "ned": "edward", "nick": "nicholas", "nicky": "nicholas", "paco": "francisco", "pancho": "francisco", "pat": "patricia patrick", "patty": "patricia", "patsy": "patricia", "pepe": "jose", "pete": "peter", "phil": "philip", "pippa": "philippa", "ray": "raymond", "rick": "richard", "ricky": "richard", "rich": "richard", "rob": "robert", "robbie": "robert", "ron": "ronald", "rosie": "rosalind", "roz": "rosalind", "sam": "samuel samantha", "sammy": "samuel samantha", "sandy": "alexandra", "sasha": "alexander alexandra", "steve": "steven", "sue": "susannah susan", "susie": "susannah susan", "suzy": "susannah", "ted": "edward theodore", "teddy": "edward theodore", "theo": "theodore", "tess": "theresa", "tim": "timothy", "timmy": "timothy", "tina": "christina martina", "tom": "thomas", "tommy": "thomas", "tori": "victoria", "vicky": "victoria", "vic": "victor", "vince": "vincent", "walt": "walter", "wally": "walter", "will": "william", "willy": "william", "liam": "william", "xan": "alexander", "zach": "zachary", "zack": "zachary", "uli": "ulrich", "vanya": "ivan", "lena": "helena", "toni": "antonia", "manny": "manuel", "drew": "andrew", "dee": "delia", "cal": "callum", "cat": "catalina catherine", "lina": "catalina", "nessa": "vanessa", "tam": "tamsin", "seun": "oluwaseun", "nastya": "anastasia", "cata": "catalina", "peg": "margaret", "sandra": "alexandra", "jamie": "james", "trish": "patricia", "gus": "augustus", "hal": "henry",
}
WORD = re.compile(r"[^\W\d_]+(?:[’'\-][^\W\d_]+)*\.?|,", re.U)


def fold(text: str) -> str:
    """Lower case without accents; ø, ł and the like by their base letter."""
    text = text.lower().translate({0xF8: "o", 0x142: "l", 0xDF: "ss", 0xE6: "ae", 0x111: "d", 0xF0: "d"})
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def reading(name: str, code: Code) -> tuple[str, str, str, str]:
    """(kind, family, given, initials) of a name, folded. kind: "org" (family holds the whole key), "full", "initial", or "none" for a generic byline."""
    plain = re.sub(r"[\"“(][^\"”)]*[\"”)]", " ", name)
    tokens = [t for t in WORD.findall(plain)]
    low = [fold(t).rstrip(".") for t in tokens]
    if not low or " ".join(w for w in low if w != ",") in GENERIC:
        return "none", "", "", ""
    if any(w in ORG for w in low) and len(low) > 1:
        words = [SHORT_WORDS.get(w, w) for w in low if w not in JOINING and w not in (",", "inc", "ltd", "llc", "corp")]
        heads = [w for w in words if w in ORG]
        rest = [w for w in words if w not in ORG]
        return "org", " ".join([*rest[:1], *heads, *rest[1:]]), "", ""
    typed = [(t, w) for t, w in zip(tokens, low) if w == "," or w not in TITLE and (w not in SUFFIX or len(low) <= 2 and t.isupper())]
    while typed and typed[-1][1] == ",":
        typed.pop()
    low = [w for _, w in typed]
    if "," in low:
        at = low.index(",")
        family, given = typed[:at], [x for x in typed[at + 1 :] if x[1] != ","]
    else:
        family, given = [], []
        initial = [len(w) == 1 or t.isupper() and len(w) <= 3 and not all(x.isupper() for x, _ in typed) for t, w in typed]
        full = [i for i, (x, (_, w)) in enumerate(zip(initial, typed)) if not x and w not in PARTICLE]
        if not full:
            return "none", "", "", ""
        if len(full) == 1:
            family, given = [typed[full[0]]], [x for x, y in zip(typed, initial) if y]
        else:
            first, last = typed[full[0]], typed[full[-1]]
            bits = lambda p, x: code._bits(p, x[1] if (p, x[1]) in code.counts else x[0].rstrip(".").lower())
            turned = bits("F", first) + bits("G", last) + 1 < bits("G", first) + bits("F", last) and not any(initial)
            turned = turned or typed[0][1] in PARTICLE
            family, given = ([first], typed[full[0] + 1 :]) if turned else ([last], typed[: full[-1]])
    fam = " ".join(w for _, w in family if w not in PARTICLE).replace("-", " ") or " ".join(w for _, w in family)
    fam = re.sub(r"^(?:al|el) ", "", fam)
    given = [(t, w) for t, w in given if w not in PARTICLE]
    words = [w for t, w in given if len(w) > 1 and not (t.isupper() and len(w) <= 3 and len(given) == 1 and not name.isupper())]
    letters = "".join(w if (t.isupper() and len(w) <= 3 and w not in words) else w[0] for t, w in given)
    if not fam:
        return "none", "", "", ""
    if words and given[0][1] == words[0]:
        # Jean-Luc, Jean Luc and JeanLuc are one name, if the hyphened form is known
        if len(words) > 1 and ("G", f"{words[0]}-{words[1]}") in code.counts:
            words[:2], letters = [words[0] + words[1]], letters[:1] + letters[2:]
        return "full", fam, words[0].replace("-", ""), letters
    return ("initial" if letters else "none"), fam, "", letters


def near(a: str, b: str) -> bool:
    """Whether two strings are one insertion, deletion, substitution or exchange of neighbours apart, or equal: a ball of the Damerau-Levenshtein metric."""
    if a == b:
        return True
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    if len(a) < len(b):
        return a[i:] == b[i + 1 :]
    return a[i + 1 :] == b[i + 1 :] or a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :]


@F.pandas_udf(BooleanType())
def _near(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([near(x, y) for x, y in zip(a, b)], dtype=bool)


GROUPS, RADIUS = 7, 1


def _cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The cells of each string. Pivots are the strings of one letter; the distance of x to a long run of a letter is the run's
    length less the count of that letter in x. By the triangle inequality strings at distance r or less differ by at most r in the
    distance to any pivot, and one edit changes at most two of the distances. Pivots are held in GROUPS groups; a cell is the
    distances to all but two groups. A string stands in its cell for each two groups left out, so two strings within the radius share one."""
    left_out = list(itertools.combinations(range(GROUPS), 2 * RADIUS))
    for b in batches:
        out = []
        for s in b["key"]:
            parts: list[list[str]] = [[] for _ in range(GROUPS)]
            for c in sorted(s):
                parts[ord(c) % GROUPS].append(c)
            whole = ["".join(p) for p in parts]
            out += [(s, f"{i}{j}|" + "|".join(w for k, w in enumerate(whole) if k not in (i, j))) for i, j in left_out]
        yield pd.DataFrame(out, columns=["key", "cell"])


def radius_join(keys: DataFrame) -> DataFrame:
    """``a, b``, a < b: the pairs of the distinct strings in ``key`` at distance 1, each once. Exact; work grows with the strings, not their pairs."""
    # strings are few bytes but many cells: they are dealt to all tasks before that
    tasks = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = keys.select("key").distinct().repartition(tasks).mapInPandas(_cells, "key string, cell string").select("key", F.xxhash64("cell").alias("cell"))
    left, right = placed.withColumnRenamed("key", "a"), placed.withColumnRenamed("key", "b")
    return left.join(right, "cell").where((F.col("a") < F.col("b")) & (F.abs(F.length("a") - F.length("b")) <= RADIUS)).select("a", "b").distinct().where(_near("a", "b"))


def entities(df: DataFrame, id_col: str, field: str) -> DataFrame:
    """``name, entity``: every distinct name string of the field that names somebody, and the entity it is linked to (the least key of its own).

    Names are read as family, given and initials, or as an organisation's words in one order, without accents, titles, suffixes and
    articles. Keys "given family" and organisations' keys within distance 1 are linked by radius_join, unless both given names are
    usual ones (Joan, John). A name with initials or a usual short form for its given name is linked to the entity of
    its family that it fits, if just one does, by the same metric for a family name mistyped. Short forms (Jen, Jenny) of a family without
    the given name itself are linked if they stand for just one name, and are what initials fit then. Null and "" fields hold no names; a name that
    fits several entities, or none, stands alone, with other spellings of the same initials. Names that come often cost as much as names that come once.
    """
    code = learned_code(df, field)
    counts = code.counts
    usual = {w for (p, w), n in counts.items() if p == "G" and w not in (None, "known") and n >= 3 + 2e-3 * counts[("G", None)]}

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mine = Code(counts)
        for b in batches:
            yield pd.DataFrame([(n, *reading(n, mine)) for n in b["name"]], columns=["name", "kind", "family", "given", "initials"])

    names = unpacked(df, id_col, field, code=code).select(F.col("value").alias("name")).distinct()
    known = materialize(names.mapInPandas(read, "name string, kind string, family string, given string, initials string").where("kind <> 'none'"))

    nick = {k: v.split() for k, v in NICKNAMES.items()}
    pairs = F.create_map(*itertools.chain.from_iterable((F.lit(k), F.array(*map(F.lit, v))) for k, v in nick.items()))
    known = known.withColumn("formal", F.when(F.col("kind") == "full", pairs[F.col("given")]))
    key = F.when(F.col("kind") == "org", F.col("family")).otherwise(F.concat_ws(" ", "given", "family"))
    whole = known.where("kind in ('org', 'full')").withColumn("key", key)

    # entities of whole keys: components of the keys within distance 1
    given_usual = lambda c: F.split(c, " ")[0].isin(*sorted(usual)) if usual else F.lit(False)
    close = radius_join(whole).where(~(given_usual("a") & given_usual("b") & (F.split("a", " ")[0] != F.split("b", " ")[0])))
    numbered = lambda c: F.xxhash64(c)
    linked = components(close.select(numbered("a").alias("a"), numbered("b").alias("b")))
    keyed = whole.withColumn("node", numbered("key")).join(linked, "node", "left").withColumn("entity", F.coalesce("root", "node"))
    keyed = materialize(keyed.select("name", "kind", "family", "given", "initials", "formal", "key", "entity"))

    # a usual short form belongs to the one entity of its family with a given name it stands for
    persons = keyed.where("kind = 'full' and formal is null").groupBy("family", "given", "entity").agg(F.max(F.length("initials")).alias("width"), F.max("initials").alias("letters"))
    persons = materialize(persons)
    short = materialize(keyed.where("formal is not null").select(F.col("entity").alias("from"), "family", F.explode("formal").alias("given")).distinct())
    fitting = short.join(persons.select("family", "given", "entity"), ["family", "given"]).groupBy("from").agg(F.min("entity").alias("to"), F.count_distinct("entity").alias("n"))
    fitting = materialize(fitting)
    moved = materialize(fitting.where("n = 1").select("from", "to"))

    # without one, short forms that stand for just one given name are one entity of their family, and other short forms belong to it as to a given name
    bare = short.join(fitting, "from", "left_anti")
    bare = materialize(bare)
    sole = bare.join(bare.groupBy("from").agg(F.count_distinct("given").alias("n")).where("n = 1"), "from", "left_semi")
    sole = materialize(sole)
    held = sole.groupBy("family", "given").agg(F.min("from").alias("to"))
    one = bare.join(sole, "from", "left_anti").join(held, ["family", "given"]).groupBy("from").agg(F.min("to").alias("to"), F.count_distinct("family", "given").alias("n")).where("n = 1").select("from", "to")
    joined = components(sole.join(held, ["family", "given"]).select("from", "to").union(one).toDF("a", "b")).toDF("from", "to")

    # who is meant by initials: full names, short forms too unless they belong to another's given name
    persons = persons.union(keyed.where("formal is not null").join(moved.withColumnRenamed("from", "entity"), "entity", "left_anti").groupBy("family", "given", "entity").agg(F.max(F.length("initials")).alias("width"), F.max("initials").alias("letters")))
    persons, moved = materialize(persons), materialize(moved.union(joined))

    # initials: entities of the family whose given name begins so, and whose further initials, where both have some, agree
    initials = known.where("kind = 'initial'").select("name", "family", "initials")
    fams = persons.select("family").distinct().withColumnRenamed("family", "key")
    strange = initials.select(F.col("family").alias("key")).distinct().join(fams, "key", "left_anti")
    mistyped = materialize(radius_join(strange.union(fams)))
    also = mistyped.select(F.col("a").alias("family"), F.col("b").alias("meant")).union(mistyped.select(F.col("b").alias("family"), F.col("a").alias("meant"))).join(strange.withColumnRenamed("key", "family"), "family", "left_semi")
    target = initials.withColumn("meant", F.col("family")).join(fams.withColumnRenamed("key", "meant"), "meant", "left_semi").select("name", "initials", "meant").union(initials.join(also, "family").select("name", "initials", "meant"))
    fits = (F.substring("initials", 1, 1) == F.substring("given", 1, 1)) & ((F.length("initials") < 2) | (F.col("width") < 2) | (F.substring("initials", 1, 2) == F.substring("letters", 1, 2)))
    meant = persons.withColumnRenamed("family", "meant").join(moved.withColumnRenamed("from", "entity"), "entity", "left").withColumn("entity", F.coalesce("to", "entity"))
    placed = target.join(meant, "meant").where(fits).groupBy("name").agg(F.min("entity").alias("one"), F.count_distinct("entity").alias("n"))
    # initials that fit nobody are one among themselves if each is the beginning of the longest, else each stands for itself: J. A. and J. B. are two, and J. neither
    unplaced = initials.join(placed.where("n = 1").select("name", "one"), "name", "left").withColumn("first", F.substring("initials", 1, 1))
    unplaced = materialize(unplaced)
    longest = unplaced.where("one is null").groupBy("family", "first").agg(F.max_by("initials", F.struct(F.length("initials"), F.col("initials"))).alias("longest"))
    agree = unplaced.where("one is null").join(longest, ["family", "first"]).groupBy("family", "first", "longest").agg(F.bool_and(F.col("longest").startswith(F.col("initials"))).alias("agree"))
    meant_by = F.when(F.col("agree"), F.col("longest")).otherwise(F.col("initials"))
    own = F.xxhash64(F.concat_ws(" ", F.lit("initial"), meant_by, "family"))
    loose = unplaced.join(agree, ["family", "first"], "left").select("name", F.coalesce("one", own).alias("entity"))
    named = keyed.join(moved.withColumnRenamed("from", "entity"), "entity", "left").select("name", F.coalesce("to", "entity").alias("entity"))
    return named.union(loose)


def variants(df: DataFrame, id_col: str, field: str) -> DataFrame:
    """``name_a, name_b``, name_a < name_b: all pairs of name strings of one entity."""
    e = materialize(entities(df, id_col, field))
    a, b = e.toDF("name_a", "entity"), e.toDF("name_b", "entity")
    return a.join(b, "entity").where("name_a < name_b").select("name_a", "name_b")
