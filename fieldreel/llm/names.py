"""Variant spellings of names: merge matched records, let the richer profiles match again, until nothing merges."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldreel.llm.components import connected_components
from fieldreel.session import cut_lineage, release

# Kinds of feature with their abbreviations, compass and level words, words that qualify or mean no place.
KINDS = {
    "aid station": "aidstation as", "bridge": "bridge brdg br", "campground": "campground campgrd cmpgrd cg", "canyon": "canyon canyn cyn", "creek": "creek crk ck", "lake": "lake lk",
    "lodge": "lodge ldg", "meadow": "meadow meadows mdw mdws", "mountain": "mountain mount mtn mt", "overlook": "overlook ovlk", "pass": "pass ps", "ridge": "ridge rdge rdg", "springs": "springs spring spgs spg",
    "trailhead": "trailhead trlhd th", "river": "river rvr riv", "valley": "valley vly", "peak": "peak pk", "road": "road rd", "trail": "trail trl", "forest": "forest", "glacier": "glacier", "falls": "falls fls",
}
SIDES = {"north": "north nth n", "south": "south sth s", "east": "east e", "west": "west w", "upper": "upper uppr upr", "lower": "lower lowr lwr"}
QUALIFIERS = {"old", "new", "little", "big", "great"}
EMPTY = {"the", "of", "at", "near", "area", "a", "an"}
GENERAL = set("here there unknown none null na summit finish start line base camp top bottom home course race venue location place spot somewhere tbd various misc other".split())
_JOINED = ((r"\baid[\s-]*(?:station|stn|sta|st)\b\.?", " aidstation "), (r"\bover[\s-]look\b", " overlook "), (r"\btrail[\s-]head\b", " trailhead "), (r"\bcamp[\s-]ground\b", " campground "))
_KIND_OF = {w: k for k, ws in KINDS.items() for w in ws.split()}
_SIDE_OF = {w: k for k, ws in SIDES.items() for w in ws.split()}
#: Rows of keys that one task links at most on average.
KEY_ROWS = 500_000
#: A spelling may stand for another one slip away that is so many times as frequent, or if it is itself as rare as this.
MORE_FREQUENT, RARE = 3, 2
#: Keys that leave a task at once; a name may have any number of them.
KEYS_AT_ONCE = 100_000
#: Letters from which a word may be two words run together, in a name of other words and in one of that word alone.
LONG_WORD, LONE_WORD = 9, 6
#: Places in which two words must stand for one another before they do so everywhere.
LEARNT_IN = 2


@dataclass(frozen=True)
class Name:
    """A typed name: what must agree (side, qualifier, mile, kind), and its own words."""

    fixed: str
    kind: str
    words: tuple[str, ...]

    @property
    def initial(self) -> bool:
        return any(len(w) == 1 for w in self.words)

    @property
    def strong(self) -> bool:
        return bool(self.kind) and not self.initial


def parse_name(text: str | None) -> Name | None:
    """The parts of a name; None for null, blank and too general names. Notes in brackets or after a slash say a portion and are dropped, miles in them are kept."""
    if not text:
        return None
    s = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).casefold()
    mile = re.search(r"\b(?:mile|miles|mi|milepost|mp)\b\.?\s*#?\s*(\d+(?:\.\d+)?)", s)
    s = re.sub(r"\b(?:mile|miles|mi|milepost|mp)\b\.?\s*#?\s*\d+(?:\.\d+)?", " ", s)
    s = re.sub(r"\([^)]*\)?|/.*|\[[^\]]*\]", " ", s)
    for pattern, to in _JOINED:
        s = re.sub(pattern, to, s)
    own, kind, sides, quality = [], "", set(), set()
    for w in re.findall(r"[^\W\d_]+|\d+", s.replace("'", "").replace("’", "")):
        if w in EMPTY:
            continue
        if w in _KIND_OF:
            kind = kind or _KIND_OF[w]
        elif w in _SIDE_OF:
            sides.add(w)
        elif w in QUALIFIERS:
            quality.add(w)
        else:
            own.append(w)
    # a lone letter beside one word stands for the other word, not for a side
    if sum(len(w) > 1 for w in own) == 1 and len(own) == 1 and len(next(iter(own))) < 12:
        letters = [w for w in sides if len(w) == 1]
        own += letters
        sides -= set(letters)
    if all(w in GENERAL or w.isdigit() or len(w) == 1 for w in own):
        return None
    fixed = "|".join((" ".join(sorted({_SIDE_OF[w] for w in sides})), " ".join(sorted(quality)), str(float(mile[1])) if mile else ""))
    return Name(fixed, kind, tuple(sorted(own)))


def one_slip(a: str, b: str) -> bool:
    """Whether the words are one letter left out, added, replaced or swapped with its neighbour apart. In words under five letters a replaced one makes another word."""
    if a == b or abs(len(a) - len(b)) > 1 or min(len(a), len(b)) < 3:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) != len(b):
        return a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]
    return (a[i + 1 :] == b[i + 1 :] and len(a) >= 5) or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])


def abbreviates(short: str, full: str) -> bool:
    """Whether the first word holds some letters of the second in order, the first among them, and at most two thirds of it."""
    if len(short) < 2 or 3 * len(short) > 2 * len(full) or short[0] != full[0]:
        return False
    letters = iter(full)
    return all(c in letters for c in short)


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text)


def _cuts(words: list[str]) -> list[tuple[int, int]]:
    """(word, letter) at which a name's word may be two run together."""
    least = LONE_WORD if len(words) == 1 else LONG_WORD
    return [(k, i) for k, w in enumerate(words) if len(w) >= least for i in range(3, len(w) - 2)]


def name_keys(fixed: str, kind: str, words: list[str], stands_for: dict[str, list[str]], halves: dict[str, list[str]]) -> Iterator[tuple[int, bool]]:
    """(key, of initials) of a name, some more than once: names that share a key agree in their words up to one slip each, order, and two words run together; keys of initials hold one letter in place of a word.

    All spellings come, one at a time, so their number (the product of those of the words) takes time but no memory.
    """
    lists = [[stands_for.get(w, [w]) for w in words]]
    for k, i in _cuts(words):
        a, b = halves.get(words[k][:i]), halves.get(words[k][i:])
        if a and b:
            lists.append([*lists[0][:k], a, b, *lists[0][k + 1 :]])
    for n, options in enumerate(lists):
        for spelling in product(*options):
            yield _hash(f"{fixed}|{' '.join(sorted(spelling))}"), False
            if n == 0 and len(words) > 1:
                letters = sum(len(w) == 1 for w in words)
                for k, w in enumerate(spelling):
                    if (letters == 0 and len(w) > 1) or (letters == 1 and len(w) == 1):
                        yield _hash(f"{fixed}|{kind}|{w[0]}|{' '.join(sorted([*spelling[:k], *spelling[k + 1 :]]))}"), True


def _signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for row, text in zip(batch["row"], batch["name"], strict=True):
            if (n := parse_name(text)) is not None:
                out.append((row, _signed(_hash(f"{n.fixed}|{n.kind}|{' '.join(n.words)}")), n.fixed, n.kind, " ".join(n.words), n.strong, n.initial))
        yield pd.DataFrame(out, columns=["row", "node", "fixed", "kind", "words", "strong", "short"])


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The words of each name, and the halves of those that may be run together."""
    for batch in batches:
        out: set[tuple] = set()
        for node, joined in zip(batch["node"], batch["words"], strict=True):
            words = joined.split(" ")
            out |= {(node, w, False) for w in words}
            out |= {(node, h, True) for k, i in _cuts(words) for h in (words[k][:i], words[k][i:])}
        yield pd.DataFrame(list(out), columns=["node", "text", "half"])


def _slips(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch[[one_slip(a, b) for a, b in zip(batch["text"], batch["other"], strict=True)]]


def _spellings(texts: DataFrame, learnt: DataFrame) -> DataFrame:
    """Rows (text, half, reps) of the words and halves that may stand for other words: a word for itself, for more frequent ones one slip away and for those it was learnt to mean; a half only for words that the names hold.

    Words within one slip share a form with a letter left out. A form is shared by words with one letter more only, so
    what meets in it is bounded by the alphabet and the word's length.
    """
    known = texts.where("NOT half").groupBy("text").agg(F.count("*").alias("n"))
    asked = cut_lineage(texts.groupBy("text").agg(F.max("half").alias("half"), F.max(~F.col("half")).alias("word")).join(known, "text", "left").withColumn("n", F.coalesce("n", F.lit(0))))
    forms = lambda c: F.explode(F.concat(F.array(c), F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.concat(F.left(c, i - 1), F.substr(c, i + 1))))).alias("form")
    left = asked.where(F.length("text") >= 3).select("text", "n", "word", forms(F.col("text")))
    right = asked.where(F.col("word") & (F.length("text") >= 3)).select(F.col("text").alias("other"), F.col("n").alias("m"), forms(F.col("text")))
    better = (F.col("m") > F.col("n")) | ((F.col("m") == F.col("n")) & (F.col("other") < F.col("text")))
    near = left.join(right, "form").where((F.col("text") != F.col("other")) & (~F.col("word") | (better & ((F.col("m") >= MORE_FREQUENT * F.col("n")) | (F.col("n") <= RARE)))))
    near = near.select("text", "other", "m").distinct().mapInPandas(_slips, "text string, other string, m bigint").select("text", "other", "m")
    near = near.union(learnt.join(asked.where("word").select(F.col("text").alias("other"), F.col("n").alias("m")), "other").select("text", "other", "m")).distinct()
    near = near.groupBy("text").agg(F.array_sort(F.collect_list(F.struct(-F.col("m"), F.col("other").alias("rep")))).alias("near"))
    reps = F.coalesce(F.transform("near", lambda x: x["rep"]), F.array().cast("array<string>"))
    own = F.when(F.col("word"), F.array("text")).otherwise(F.array().cast("array<string>"))
    return asked.join(near, "text", "left").select("text", "word", "half", F.concat(reps, own).alias("reps")).where("size(reps) > 1 OR (half AND size(reps) > 0)")


def _keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["key", "initial", "node", "kind"]
    out: set[tuple] = set()
    for batch in batches:
        for node, fixed, kind, joined, found in zip(batch["node"], batch["fixed"], batch["kind"], batch["words"], batch["found"], strict=True):
            stands_for, halves = {}, {}
            for f in found if found is not None else []:
                halves[f["text"]] = list(f["reps"])
                if f["word"]:
                    stands_for[f["text"]] = list(f["reps"])
            for k, initial in name_keys(fixed, kind, joined.split(" "), stands_for, halves):
                out.add((_signed(k), initial, node, kind))
                if len(out) >= KEYS_AT_ONCE:
                    yield pd.DataFrame(list(out), columns=columns)
                    out = set()
    yield pd.DataFrame(list(out), columns=columns).astype({"key": "int64", "initial": bool, "node": "int64"})


def _odd_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of names of three words or more, each word with a key of what the name is without it but its first letter."""
    for batch in batches:
        out = []
        for fixed, kind, joined in zip(batch["fixed"], batch["kind"], batch["words"], strict=True):
            words = joined.split(" ")
            if len(words) > 2:
                out += [(_signed(_hash(f"{fixed}|{kind}|{w[0]}|{' '.join([*words[:k], *words[k + 1 :]])}")), w) for k, w in enumerate(words) if len(w) > 1]
        yield pd.DataFrame(out, columns=["key", "word"])


def _shorter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch[[abbreviates(a, b) for a, b in zip(batch["text"], batch["other"], strict=True)]]


def _abbreviations(spelled: DataFrame) -> DataFrame:
    """Rows (text, other): words that abbreviate the longest one in their place, in names of three words or more that agree in all others."""
    odd = spelled.select("fixed", "kind", "words").mapInPandas(_odd_words, "key bigint, word string").distinct()
    longest = odd.groupBy("key").agg(F.max(F.struct(F.length("word").alias("size"), "word"))["word"].alias("other"), F.count("*").alias("n")).where("n > 1")
    return odd.join(longest, "key").where("word <> other").select(F.col("word").alias("text"), "other").distinct().mapInPandas(_shorter, "text string, other string")


def _learnt(named: DataFrame, place_of: DataFrame) -> DataFrame:
    """Rows (text, other): words that stand for a longer one, as names of one place show that agree in all other words, in at least ``LEARNT_IN`` places."""
    rows = named.join(place_of, named["row"] == place_of["node"]).select("place", "fixed", F.split("words", " ").alias("w")).where("size(w) > 1").distinct()
    rows = rows.select("place", "fixed", "w", F.posexplode("w").alias("k", "word")).where("length(word) > 1")
    rest = F.array_sort(F.filter("w", lambda x, i: i != F.col("k")))
    sets = rows.groupBy("place", "fixed", rest.alias("rest")).agg(F.max(F.struct(F.length("word"), F.col("word").alias("word")))["word"].alias("other"), F.collect_set("word").alias("words")).where("size(words) > 1")
    pairs = sets.select("place", "other", F.explode("words").alias("text")).where("text <> other").groupBy("text", "other").agg(F.count_distinct("place").alias("n"))
    return pairs.where(F.col("n") >= LEARNT_IN).select("text", "other")


def _chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links each row to the row before of the same key; a partition holds all rows of its keys."""
    rows = [b for b in batches if len(b)]
    if rows:
        all_rows = pd.concat(rows).sort_values(["key", "kind", "node"], kind="stable")
        same = ((all_rows["key"] == all_rows["key"].shift()) & (all_rows["kind"] == all_rows["kind"].shift())).to_numpy()
        before = all_rows["node"].shift(fill_value=0).to_numpy()[same]
        node = all_rows["node"].to_numpy()[same]
        yield pd.DataFrame({"a": before, "b": node})[lambda x: x["a"] != x["b"]].drop_duplicates()


def _linked_weak(named: DataFrame, keys: DataFrame, places: DataFrame) -> DataFrame:
    """``places`` (node, place) after names without a kind or with an initial have met the profiles, until none merges anything."""
    # a weak name stands for its row, a strong one for itself
    weak = named.where("NOT strong").select("row", "node").distinct()
    weak_keys = keys.where("NOT strong AND (initial = short OR (initial AND NOT short))").join(weak, "node").select("key", "initial", F.col("row").alias("member"), "short")
    asked = weak_keys.where("initial = short").select("key").distinct()
    met = cut_lineage(keys.where("strong").join(asked, "key", "left_semi").select("key", "initial", F.col("node").alias("member"), "short").union(weak_keys.join(asked, "key", "left_semi")).distinct())
    traits = named.where("strong").select("node", "kind", "fixed").distinct()
    while True:
        known = traits.join(places, "node").groupBy("place").agg(F.min("kind").alias("kind"), F.min("fixed").alias("fixed"))
        now = met.join(places.select(F.col("node").alias("member"), "place"), "member").join(known, "place", "left")
        full = F.when(~F.col("short"), F.col("place"))
        groups = now.groupBy("key", "initial").agg(F.min("place").alias("lowest"), F.max("place").alias("most"), F.min("kind").alias("k1"), F.max("kind").alias("k2"), F.min("fixed").alias("f1"), F.max("fixed").alias("f2"), F.min(full).alias("p1"), F.max(full).alias("p2"))
        one = F.when(F.col("initial"), F.col("p1") == F.col("p2")).otherwise((F.col("k1").isNull() | (F.col("k1") == F.col("k2"))) & (F.col("f1").isNull() | (F.col("f1") == F.col("f2"))))
        groups = groups.where(one & (F.col("lowest") < F.col("most"))).select("key", "initial", F.col("lowest").alias("least"))
        merge = cut_lineage(now.join(groups, ["key", "initial"]).select(F.col("place").alias("a"), F.col("least").alias("b")).where("a <> b").distinct())
        if merge.isEmpty():
            release(merge, met)
            return places
        to = connected_components(merge, "a", "b").select(F.col("id").alias("place"), F.col("group_id").alias("to"))
        merged = cut_lineage(places.join(to, "place", "left").select("node", F.coalesce("to", "place").alias("place")))
        release(merge, places)
        places = merged


def link_names(df: DataFrame, key: str, name: str, aliases: str) -> DataFrame:
    """One row (id, place) for each id with a usable name; rows of one place have one ``place``.

    A name is read into what must agree (compass and upper/lower words, qualifier, mile number, kind of feature) and its
    own words, of which there may be any number. Names with all of it that share their words up to one slip each (see
    ``one_slip``), in any order or two of them run together, match at once, as do those of three words or more of which
    one is abbreviated. Rows matched through any of their names merge into profiles. Names without a kind, or with an
    initial for a word, then meet the profiles: they match where the profiles that share their words agree in kind, side
    and mile (for an initial: where there is one such profile). This is repeated until none merges anything.

    Merged profiles then teach spellings: words that stand for one another in at least ``LEARNT_IN`` places, as
    abbreviations and nicknames do, become spellings of one another, and all names enter blocking anew with these, until
    nothing new is learnt or merged.

    Null, blank and too general names link nothing; a row that has no other is left out. Null aliases are as none; null
    ids are left out; repeated rows count once. An empty table gives no rows. Other columns are ignored. Rows of one key
    are linked in a chain, never in pairs.
    """
    base = df.select(F.col(key).alias("id"), F.array_compact(F.concat(F.array(F.col(name)), F.coalesce(F.col(aliases), F.array().cast("array<string>")))).alias("names")).where("id IS NOT NULL")
    rows = base.select("id", F.xxhash64(F.lit("row"), "id").alias("row"), F.explode("names").alias("name")).distinct()
    named = cut_lineage(rows.select("row", "name").mapInPandas(_parse, "row bigint, node bigint, fixed string, kind string, words string, strong boolean, short boolean").distinct())
    spelled = cut_lineage(named.drop("row").distinct())
    texts = cut_lineage(spelled.select("node", "words").mapInPandas(_texts, "node bigint, text string, half boolean"))
    own = named.select(F.col("row").alias("a"), F.when(F.col("strong"), F.col("node")).otherwise(F.col("row")).alias("b")).distinct()
    places: DataFrame | None = None
    learnt = cut_lineage(_abbreviations(spelled))
    while True:
        found = texts.join(_spellings(texts, learnt), "text").groupBy("node").agg(F.collect_set(F.struct("text", "word", "reps")).alias("found"))
        keys = spelled.join(found, "node", "left").select("node", "fixed", "kind", "words", "found").mapInPandas(_keys, "key bigint, initial boolean, node bigint, kind string")
        keys = cut_lineage(keys.join(spelled.select("node", "strong", "short"), "node"))
        parts = max(1, keys.count() // KEY_ROWS)
        alike = keys.where("strong AND NOT initial").select("key", "kind", "node").repartition(parts, "key").mapInPandas(_chain, "a bigint, b bigint")
        edges = own.union(alike)
        if places is not None:
            edges = edges.union(places.select(F.col("node").alias("a"), F.col("place").alias("b")))
        before, places = places, cut_lineage(connected_components(edges, "a", "b").select(F.col("id").alias("node"), F.col("group_id").alias("place")))
        places = _linked_weak(named, keys, places)
        taught = cut_lineage(_learnt(named, places).union(learnt).distinct())
        new = taught.count() - learnt.count()
        release(keys, learnt, *([before] if before is not None else []))
        learnt = taught
        if not new:
            break
    return rows.select("id", "row").distinct().join(places, F.col("row") == F.col("node")).select("id", "place")


def place_groups(df: DataFrame, key: str, name: str, aliases: str) -> DataFrame:
    """One row (id, group_id) for each id that ``link_names`` links or not: group_id is the smallest id of its place."""
    linked = cut_lineage(link_names(df, key, name, aliases))
    return linked.join(linked.groupBy("place").agg(F.min("id").alias("group_id")), "place").select("id", "group_id")


def same_places(df: DataFrame, key: str, name: str, aliases: str, block: int = 1_000) -> DataFrame:
    """Distinct pairs (id_lo, id_hi) of rows that ``link_names`` gives one place; a row alone has no pair. ``place_groups`` says the same without pairs.

    The rows of a place of more than ``block`` rows meet in a grid of blocks of about that size.
    """
    linked = cut_lineage(link_names(df, key, name, aliases))
    size = linked.groupBy("place").agg(F.ceil(F.count("*") / block).cast("int").alias("cuts"))
    rows = linked.join(size, "place").withColumn("cut", F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int"))
    each = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))
    left = rows.select(F.col("id").alias("id_lo"), "place", F.col("cut").alias("x"), each.alias("y"))
    right = rows.select(F.col("id").alias("id_hi"), "place", F.col("cut").alias("y"), each.alias("x"))
    return left.join(right, ["place", "x", "y"]).where("id_lo < id_hi").select("id_lo", "id_hi")
