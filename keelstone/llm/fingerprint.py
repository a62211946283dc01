"""Canonical exact fingerprints, in DataFrame functions only.

A text's canonical form is its Unicode compatibility decomposition with case and white space folded.
Spark has no normalisation function, so the form is built from expressions whose tables come from
Python's ``unicodedata`` on the driver: each different character that has a decomposition is looked
up by ``translate`` and replaced, Hangul syllables are taken apart by arithmetic, then runs of marks (of a
class other than 0) are sorted by class.  ASCII texts skip all of it.  The tables are a written row that rows
of other texts meet by a broadcast join: as literals they would stand in every plan, and the driver writes out a
plan, some MB then, each time that adaptive execution changes it.

The fingerprint is 128 bits of xxhash64 in hexadecimal.  Texts that share one are compared by their
canonical bytes; should two differ, those fingerprints get the SHA-256 of the bytes appended, so equal
fingerprints mean equal canonical texts.  Likeness is therefore 1 or 0.

Defined results: a null text counts as empty; empty texts share one fingerprint; rows without an
id come first in the order of ids, rows with equal ids follow one another by the hash of their text;
in a table of one row the next document is the row itself; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import sys
import unicodedata
from collections import Counter
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelstone.llm.common import staged

#: Buckets of neighbouring ids, and so rows of the broadcast table of their first documents, at most.
MOST_BUCKETS = 1 << 16
_STEP = 256

#: Groups of equal fingerprints of more than one row in so many are joined by broadcast; there are no more than that.
HOT_SHARE = 1000

#: Fixed values of Unicode: Hangul syllables, and how many vowels and finals (none included) follow each initial.
SYLLABLES, INITIALS, VOWELS, FINALS = (0xAC00, 0xD7A3), (0x1100, 19), (0x1161, 21), (0x11A7, 28)


@cache
def _tables() -> tuple[list[tuple[str, str]], str, str, str]:
    """For each k the characters whose form has a k-th character, with those; marks, their classes as characters, and a pattern of a mark."""
    forms, marks = [], []
    for point in range(0x80, sys.maxunicode + 1):
        c = chr(point)
        if 0xD800 <= point < 0xE000 or SYLLABLES[0] <= point <= SYLLABLES[1]:
            continue
        if (form := unicodedata.normalize("NFKD", c)) != c:
            forms.append((c, form))
        if order := unicodedata.combining(c):
            marks.append((c, chr(0x100 + order)))
    longest = max(len(f) for _, f in forms)
    parts = [("".join(c for c, f in forms if len(f) > k), "".join(f[k] for _, f in forms if len(f) > k)) for k in range(longest)]
    points = [ord(c) for c, _ in marks]
    first = [p for i, p in enumerate(points) if not i or p != points[i - 1] + 1]
    last = [p for i, p in enumerate(points) if i + 1 == len(points) or p + 1 != points[i + 1]]
    pattern = "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(first, last, strict=True)) + "]"
    return parts, "".join(c for c, _ in marks), "".join(o for _, o in marks), pattern


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _syllables(text: Column) -> Column:
    """Hangul syllables as their two or three letters."""
    initials, vowels = (F.array(*[F.lit(chr(start + i)) for i in range(n)]) for start, n in (INITIALS, VOWELS))
    finals = F.array(F.lit(""), *[F.lit(chr(FINALS[0] + i)) for i in range(1, FINALS[1])])
    low, high = map(chr, SYLLABLES)

    def letters(c: Column) -> Column:
        n = F.ascii(c) - SYLLABLES[0]
        each = VOWELS[1] * FINALS[1]
        own = F.concat(F.get(initials, F.floor(n / each).cast("int")), F.get(vowels, F.floor(n % each / FINALS[1]).cast("int")), F.get(finals, n % FINALS[1]))
        return F.when(c.between(low, high), own).otherwise(c)

    return F.when(F.rlike(text, F.lit(f"[{low}-{high}]")), F.array_join(F.transform(F.split(text, ""), letters), "")).otherwise(text)


def _written_tables(spark: SparkSession) -> DataFrame:
    """(_wide, _tables): one row of ``_tables()`` to join by ``_wide``, true."""
    parts, marks, classes, mark = _tables()
    fields = {"marks": marks, "classes": classes, "mark": mark}
    for k, (own, to) in enumerate(parts):
        fields |= {f"own{k}": own, f"to{k}": to}
    row = spark.range(1).select(F.lit(True).alias("_wide"), F.struct(*[F.lit(v).alias(k) for k, v in fields.items()]).alias("_tables"))
    return F.broadcast(staged(row, "unicode"))


def _wide(text: str) -> Column:
    """Whether a text has other characters than ASCII."""
    return F.coalesce(F.octet_length(text) != F.char_length(text), F.lit(False))


def _decomposed(text: Column, tables: Column) -> Column:
    parts = [(tables[f"own{k}"], tables[f"to{k}"]) for k in range(len(_tables()[0]))]

    def form(c: Column) -> Column:
        return F.concat(*[F.when(F.contains(own, c), F.call_function("translate", c, own, to)).otherwise("") for own, to in parts])

    def sorted_marks(run: Column) -> Column:
        # marks of one class keep their order
        own = F.transform(F.split(run, ""), lambda c, i: F.struct(F.call_function("translate", c, tables["marks"], tables["classes"]).alias("o"), i.alias("i"), c.alias("c")))
        return F.array_join(F.transform(F.array_sort(own), lambda m: m["c"]), "")

    def ordered(t: Column) -> Column:
        runs = F.array_distinct(F.regexp_extract_all(t, F.concat(tables["mark"], F.lit("{2,}")), F.lit(0)))
        # longer runs first: a shorter one in disorder isn't part of a sorted one
        longest = F.transform(F.array_sort(F.transform(runs, lambda r: F.struct((-F.length(r)).alias("n"), r.alias("r")))), lambda x: x["r"])
        return F.aggregate(longest, t, lambda u, r: F.replace(u, r, sorted_marks(r)))

    own = F.filter(F.array_distinct(F.split(F.regexp_replace(text, r"[\x00-\x7F]+", ""), "")), lambda c: (c != "") & F.contains(parts[0][0], c))
    whole = _syllables(F.aggregate(own, text, lambda t, c: F.replace(t, c, form(c))))
    return _let(whole, lambda t: F.when(F.rlike(t, F.lit(r"\p{M}{2}")), ordered(t)).otherwise(t))


def canonical(text: Column, tables: Column) -> Column:
    """Compatibility decomposition with case and white space folded; ``tables`` may be null where the text is ASCII."""
    form = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(_let(text, lambda t: F.lower(F.upper(_decomposed(t, tables)))))
    return F.trim(F.regexp_replace(form, r"[\s\p{Z}]+", " "))


def digest(canon: Column) -> Column:
    """128 bits of xxhash64 over the canonical bytes, as 32 hexadecimal digits."""
    return _let(canon, lambda c: F.lower(F.concat(*[F.lpad(F.hex(h), 16, "0") for h in (F.xxhash64(c), F.xxhash64(F.lit(1), c))])))


def _bucket(docs: DataFrame, id_col: str, key: str) -> Column:
    """Number of the range that a row is in, for ranges of about equal rows in the order of ids and then of ``key``.

    An id that fills more than one range by itself (or no id at all) is cut by its keys, which are hashes.
    """
    n = min(MOST_BUCKETS, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / n for i in range(1, n)] or [0.5]
    row = docs.agg(F.percentile_approx(id_col, shares, 10 * n).alias("cuts"), F.count_if(F.col(id_col).isNull()).alias("none"), F.count(F.lit(1)).alias("all")).first()
    times = Counter(row["cuts"] or [])
    cuts = sorted(times)
    value = F.col(id_col)
    number = F.lit(0)
    if cuts:
        blocks = [cuts[i : i + _STEP] for i in range(0, len(cuts), _STEP)]
        block = F.array_size(F.filter(F.array(*[F.lit(b[0]) for b in blocks]), lambda x: x <= value))
        inner = F.array_size(F.filter(F.get(F.array(*[F.array(*map(F.lit, b)) for b in blocks]), F.greatest(block - 1, F.lit(0))), lambda x: x <= value))
        number = F.when(value.isNull() | (block == 0), 0).otherwise((block - 1) * _STEP + inner)

    def slices(share: float) -> Column:
        # 2 to 4096 of them, by the first bits of the key
        bits = min(12, max(1, math.ceil(math.log2(max(2, share)))))
        return F.shiftright(key, 64 - bits) + (1 << (bits - 1))

    hot = [(v, m) for v, m in times.items() if m > 1]
    own = F.when(value.isNull(), 1 + slices(n * row["none"] / max(1, row["all"])))
    for v, m in hot:
        own = own.when(value == v, slices(m + 1))
    for v, _ in hot:  # what comes after such an id in its range
        own = own.when((value > v) & (number == 1 + cuts.index(v)), 1 << 13)
    own = own.otherwise(0)
    # rows without an id come before all others
    return (F.when(value.isNull(), -1).otherwise(number).cast("long") * (1 << 14) + own).cast("long")


def fingerprints(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, group_size).

    ``edited``: the last half of the characters replaced by the first as many of the next document.
    Documents meet their next one in ranges of ids; the first document of each range also stands
    behind the range before it.  One shuffle carries the texts; digests are computed once, written, and meet
    their texts in that shuffle, and a second written table keeps what is needed after it.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    placed = docs.withColumn("bucket", _bucket(docs, "id", "key"))
    unicode, tables = _written_tables(docs.sparkSession), F.col("_tables")
    thin = placed.withColumn("_wide", _wide("text")).join(unicode, "_wide", "left")
    thin = staged(thin.select("bucket", "id", "key", digest(canonical(F.col("text"), tables)).alias("fp")), "fingerprint")
    groups = thin.groupBy("fp").agg(F.count("*").alias("copies")).where("copies > 1")
    most = max(HOT_SHARE, thin.count() // HOT_SHARE)
    hot = F.broadcast(groups.where(F.col("copies") > most))
    told = thin.join(hot, "fp").unionByName(thin.join(hot, "fp", "left_anti").join(groups.where(F.col("copies") <= most), "fp", "left"), allowMissingColumns=True)
    heads = thin.groupBy("bucket").agg(F.min(F.struct("id", "key")).alias("head"))
    heads = heads.selectExpr("coalesce(lag(bucket) over (order by bucket), max(bucket) over ()) before", "head.id head_id", "head.key head_key")
    # one row for each range; equal rows of one id give one
    ghosts = docs.join(F.broadcast(heads), F.expr("id <=> head_id and key = head_key")).groupBy("before").agg(F.first("id").alias("id"), F.first("key").alias("key"), F.first("text").alias("text"))
    ghost_prints = thin.join(F.broadcast(heads), F.expr("id <=> head_id and key = head_key")).select(F.col("before").alias("bucket"), "id", "key", "fp").distinct()
    rows = placed.selectExpr("bucket", "id", "key", "text", "cast(null as string) fp", "false ghost", "0L copies")
    rows = rows.unionByName(ghosts.selectExpr("before bucket", "id", "key", "text", "cast(null as string) fp", "true ghost", "0L copies"))
    rows = rows.unionByName(told.selectExpr("bucket", "id", "key", "cast(null as string) text", "fp", "false ghost", "coalesce(copies, 1L) copies"))
    rows = rows.unionByName(ghost_prints.selectExpr("bucket", "id", "key", "cast(null as string) text", "fp", "true ghost", "0L copies"))
    # both windows below read this one shuffle
    rows = rows.repartition("bucket")
    same = "(partition by bucket, ghost, id, key)"
    met = rows.selectExpr("bucket", "ghost", "id", "key", "text", f"max(fp) over {same} fp", f"max(copies) over {same} copies").where("text is not null")
    follow = "over (partition by bucket order by ghost, id, key)"
    met = met.selectExpr("*", f"lead(text) {follow} next_text", f"lead(fp) {follow} next_fp").where("not ghost")
    cut = met.selectExpr("id", "text", "fp", "next_text", "next_fp", "copies", "cast(char_length(text) as bigint) n_chars")
    cut = cut.withColumn("edited", F.expr("concat(substring(text, 1, cast(n_chars - n_chars div 2 as int)), substring(next_text, 1, cast(n_chars div 2 as int)))"))
    cut = cut.withColumn("_wide", _wide("text") | _wide("next_text")).join(unicode, "_wide", "left")
    cut = cut.withColumn("edited_fp", digest(canonical(F.col("edited"), tables)))
    # canonical forms of texts that share a fingerprint with others; one expression for all three
    near_edited, near_next = F.col("fp") == F.col("edited_fp"), F.coalesce(F.col("fp") == F.col("next_fp"), F.lit(False))
    asked = F.array(F.when(near_edited | near_next | (F.col("copies") > 1), F.col("text")), F.when(near_edited, F.col("edited")), F.when(near_next, F.col("next_text")))
    cut = cut.withColumn("forms", F.transform(asked, lambda t: F.when(t.isNotNull(), canonical(t, tables))))

    def alike(met: Column, k: int) -> Column:
        return F.when(met, F.get("forms", F.lit(0)) == F.get("forms", F.lit(k))).otherwise(False).cast("double")

    # texts end here: what goes on is digests, and the canonical form of texts that share a fingerprint
    told = cut.select(
        "id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fp", "edited_fp", alike(near_edited, 1).alias("near_edited"),
        alike(near_next, 2).alias("near_next"), "copies", F.when(F.col("copies") > 1, F.get("forms", F.lit(0))).alias("canon"),
    )
    told = staged(told, "fingerprint")
    shared = told.where("canon is not null").groupBy("fp").agg(F.min("canon").alias("a"), F.max("canon").alias("b"))
    clashes = staged(shared.where("a <> b").select(F.col("fp").alias("clash")), "clashes")
    out = told.withColumn("own", F.when(F.col("canon").isNotNull(), F.sha2("canon", 256))).drop("canon")
    name = F.col("fp")
    if not clashes.isEmpty():
        out = out.join(clashes, F.col("fp") == F.col("clash"), "left")
        name = F.when(F.col("clash").isNull(), F.col("fp")).otherwise(F.concat("fp", F.lit("-"), "own"))
    return out.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", name.alias("fingerprint"), F.col("edited_fp").alias("edited_fingerprint"), "near_edited", "near_next",
        F.col("copies").alias("group_size"),
    )
