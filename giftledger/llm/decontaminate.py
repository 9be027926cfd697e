"""Benchmark decontamination with a hash set of test n-grams. DataFrame code only.

A-Z is lower-cased and words are runs of letters, digits and everything beyond ASCII. A benchmark window is 13
consecutive words of an item, or the whole of a shorter item. Every document is scanned once for hits: three words of each
window are looked up in a table of bits inside the row, windows whose bit is set are hashed and probed against the
broadcast set of benchmark hashes, and a hash that is found is verified word by word in the same join. Texts are never shuffled; a hit leaves the scan with the text's key.

The set of benchmark windows is stored and counted first and broadcast up to `BROADCAST_GRAMS` windows (of 13 words, some
200 bytes each); a larger benchmark is joined by shuffle. A window carries no items, however many share it, but a key of
the set of its items. Items are joined after the hits, once for each distinct collection of such sets that some text has.

Defined results: a null, empty or word-less text has no words and is never contaminated; items without words have no
window; items that repeat or share a window each count, an item with a null id hits words but is not listed; rows that
repeat are each returned; an empty benchmark hits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_KEYS, Steps, read, text_key

WORDS, SHARE = 13, 20
BROADCAST_GRAMS = 500_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: One character class for text as it is written, in which A-Z are word characters too.
RAW_TOKEN, RAW_GAP = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bits of the table that says which windows are worth cutting out; its size is fixed, 128 KB.
SPOTS = 1 << 20


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once for each row; Spark would repeat it inside every lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, GAP), lambda w: w != "")


def spot_of(words: Column, start: Column, length: Column) -> Column:
    """A number below `SPOTS` from the first, middle and last word of a window."""
    middle = F.floor(length / 2).cast("int")
    return F.xxhash64(words[start], words[start + middle], words[start + length - 1]).bitwiseAND(SPOTS - 1)


def spot_table(grams: DataFrame) -> Column:
    """A bit for each spot, in numbers of 64: set where a window of ``grams`` (len, words) has it."""
    spots = grams.select(spot_of(F.col("words"), F.lit(0), F.col("len")).alias("spot"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("spot").bitwiseAND(63).cast("int"))
    rows = spots.groupBy(F.shiftright("spot", 6).alias("place")).agg(F.bit_or(bit).alias("bits")).collect()  # at most SPOTS / 64
    table = [0] * (SPOTS // 64)
    for r in rows:
        table[r["place"]] = r["bits"]
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<long>")  # folded into one literal


def windows_of(words: Column, length: Column | int, table: Column | None = None) -> Column:
    """Position (from 0), length, words and hash of every window of that many words; none where there are fewer words.

    With a `spot_table`, windows whose spot is not set are left out.
    """
    length = F.lit(length) if isinstance(length, int) else length
    starts = F.when(F.size(words) >= length, F.sequence(F.lit(0), F.size(words) - length)).otherwise(F.array().cast("array<int>"))
    if table is not None:
        every = starts
        is_set = lambda spot: F.getbit(table[F.shiftright(spot, 6).cast("int")], spot.bitwiseAND(63).cast("int")) == 1
        starts = _let(F.transform(every, lambda i: spot_of(words, i, length)), lambda spots: F.filter(every, lambda i: is_set(spots[i])))
    cut = F.transform(starts, lambda i: F.struct(i.alias("pos"), length.alias("len"), F.slice(words, i + 1, length).alias("words")))
    return F.transform(cut, lambda x: F.struct(x["pos"].alias("pos"), x["len"].alias("len"), x["words"].alias("words"),
                                               F.xxhash64(x["words"]).alias("h")))


def item_windows(benchmark: DataFrame, n: int = WORDS) -> DataFrame:
    """item_id, len, words and h of each window of each item."""
    cut = _let(words_of(F.col("text")), lambda w: F.when(F.size(w) > 0, windows_of(w, F.least(F.lit(n), F.size(w)))))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.explode(cut).alias("x"))
    return items.select("item_id", "x.len", "x.words", "x.h").distinct()


def distinct_windows(windows: DataFrame) -> DataFrame:
    """h, len, words and set_key of each distinct window; windows of the same items, and only those, have the same set_key.

    The key is the number of items and two exclusive-ors of their hashes, so a window in every item is one small row.
    """
    listed = F.col("item_id").isNotNull()
    mark = lambda salt: F.hex(F.coalesce(F.bit_xor(F.when(listed, F.xxhash64(F.lit(salt), "item_id"))), F.lit(0)))
    set_key = F.concat_ws(":", F.count("item_id").cast("string"), mark("a"), mark("b"))
    return windows.groupBy("h", "len", "words").agg(set_key.alias("set_key"))


def items_of_sets(windows: DataFrame, grams: DataFrame) -> DataFrame:
    """set_key and item_id, a row for each item of each set that has any; read off one window of the set."""
    one = grams.groupBy("set_key").agg(F.min(F.struct("h", "words")).alias("w")).select("set_key", "w.*")
    return windows.where("item_id IS NOT NULL").join(one, ["h", "words"]).select("set_key", "item_id")


def hits(docs: DataFrame, windows: DataFrame, steps: Steps, items: str = "list") -> DataFrame:
    """key (of the text), n_hit, spans (runs of hit words, as start and end) of each text with a verified hit, and its items.

    ``items="list"`` gives items, the sorted ids; ``"digest"`` n_items and items_sha256 of that list, joined by commas;
    ``"none"`` neither.
    """
    grams = steps.keep(distinct_windows(windows), "grams")
    size = grams.agg(F.count("*").alias("n"), F.collect_set("len").alias("lengths")).first()  # at most one length each up to n
    table = spot_table(grams)
    texts = docs.select(text_key(F.col("text")).alias("key"), F.col("text").cast("string").alias("text"))
    cut = _let(words_of(F.col("text")), lambda w: F.concat(*[windows_of(w, n, table) for n in sorted(size["lengths"]) or [WORDS]]))
    probed = texts.select("key", F.explode(cut).alias("x")).select("key", "x.*").alias("d")
    gram = (F.broadcast(grams) if size["n"] <= BROADCAST_GRAMS else grams).alias("b")
    true = probed.join(gram, (F.col("d.h") == F.col("b.h")) & (F.col("d.words") == F.col("b.words")))
    true = steps.keep(true.select("d.key", "d.pos", "d.len", "b.set_key"), "true").distinct()
    found = true.groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("pos", "len"))).alias("at"),
        F.array_sort(F.collect_set("set_key")).alias("sets"),
    ).select("key", "sets", _let(_merged(F.col("at")), lambda runs: F.struct(runs.alias("spans"), F.aggregate(
        runs, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_hit"))).alias("r")).select("key", "sets", "r.*")
    if items == "none":
        return found.drop("sets")
    found = steps.keep(found.withColumn("all_sets", F.md5(F.array_join("sets", ","))), "found")
    each = found.groupBy("all_sets").agg(F.first("sets").alias("sets")).select("all_sets", F.explode("sets").alias("set_key"))
    listed = each.join(items_of_sets(windows, grams), "set_key").groupBy("all_sets").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    if items == "digest":
        listed = listed.select("all_sets", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    return found.drop("sets").join(listed, "all_sets", "left").drop("all_sets")


def _merged(at: Column) -> Column:
    """Runs of words that are hit, from windows in order of position."""
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def add(runs, s):
        last = F.element_at(runs, -1)
        new = F.struct(s["pos"].alias("start"), (s["pos"] + s["len"]).alias("end"))
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["pos"] + s["len"]).alias("end"))
        return F.when(F.size(runs) == 0, F.array(new)).when(
            s["pos"] <= last["end"], F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(grown))).otherwise(F.concat(runs, F.array(new)))

    return F.aggregate(at, empty, add)


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = WORDS, share: int = SHARE, items: str = "list") -> DataFrame:
    """doc_id, key, n_words, n_hit, spans and contaminated of each row, and its items as `hits` gives them.

    A document is contaminated when at least one ``share``-th of its words is hit. Rows without a hit have null items.
    """
    steps = Steps(docs.sparkSession, "decontaminate")
    windows = steps.keep(item_windows(benchmark, n), "windows")
    found = steps.keep(hits(docs, windows, steps, items), "hits")
    text = F.col("text").cast("string")
    counted = docs.select("doc_id", text_key(text).alias("key"),
                          F.coalesce(F.regexp_count(text, F.lit(RAW_TOKEN)), F.lit(0)).cast("long").alias("n_words"))
    joined = counted.join(found, "key", "left").withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long")))
    return joined.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))


def decontaminated(docs: DataFrame, benchmark: DataFrame, n: int = WORDS, share: int = SHARE, remove: str = "documents") -> DataFrame:
    """The rows of ``docs`` with all their columns, without what the benchmark contaminates.

    ``remove="documents"`` drops contaminated documents and leaves the others as they are. ``remove="spans"`` keeps every
    document and cuts the words inside any hit; a document that loses words keeps the rest joined by single spaces.
    """
    steps = Steps(docs.sparkSession, "decontaminated")
    report = contamination(docs, benchmark, n, share, "none")
    rows = docs.select(F.struct("*").alias("row"), text_key(F.col("text")).alias("key"))
    if remove == "documents":
        bad = steps.keep(report.where("contaminated").select("key").distinct(), "bad")
        bad = F.broadcast(bad) if bad.count() <= BROADCAST_KEYS else bad  # 32 bytes each
        return rows.join(bad, "key", "left_anti").select("row.*")
    cuts = steps.keep(report.where("n_hit > 0").select("key", "spans").dropDuplicates(["key"]), "cuts")
    words = F.filter(F.split(F.col("row.text"), RAW_GAP), lambda w: w != "")  # evaluated once: the lambda below is over its result
    rest = F.filter(words, lambda w, i: ~F.exists("spans", lambda s: (i >= s["start"]) & (i < s["end"])))
    cut = rows.join(cuts, "key", "left").withColumn(
        "text", F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(F.array_join(rest, " ")))
    return cut.select(F.col("row").withField("text", F.col("text")).alias("row")).select("row.*")


def op6_decontaminate(spark, sf_dir):
    report = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), items="digest")
    none = F.sha2(F.lit("").cast("binary"), 256)
    return report.select("doc_id", "n_words", "n_hit", F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                         F.coalesce("items_sha256", none).alias("items_sha256"), "contaminated")


OP6_SQL = """
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, w[i : i + least(13, len(w)) - 1] AS x
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
cut AS (
  SELECT r, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: {'i': i, 'x': w[i : i + n - 1]})) AS c
  FROM words, lengths),
found AS (SELECT r, c.i AS i, cut.n, item_id FROM cut JOIN windows ON c.x = windows.x),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
listed AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)
"""
