"""Merkle manifest of a dataset: leaf places from ranks in doc_id bitmaps, levels from arrays with keyed slots.

Every row is a leaf, the SHA-256 of its fields. The leaves of a source ascend by doc_id; 16 consecutive nodes make the
node above until one is left, the source's subroot, and the subroots, ordered by source, make the root alike.

**Places.** Nothing sorts the leaves. Each source has a bitmap of its ids, compressed to the 64-bit words that are not
zero; tasks build partial words and the shuffle merges them with OR. A directory holds how many rows lie before each
word, in four steps (word, 2^16 ids, 2^32 ids, 2^48 ids, source), so that no list of it is longer than 2^16 entries
however sparse the ids are. The rank of a row is the directory's count and the number of bits below its own. Words with
more rows than bits hold repeated ids: there copies of one leaf are counted, and different leaves with one id take
their places by a directory of digest prefixes, so a third of all rows may repeat one id.

**Levels.** A node goes to the array of its parent (place / 16) under its slot (place % 16); an array has at most 16.
Going down again, each node's siblings are put before those of its parent, which gives every leaf its proof.

Defined results: a null field enters its leaf as `-`; rows without an id come first in their source and a null source
comes first of all; rows that repeat an id are ordered by digest, and copies are interchangeable; an empty text is `0:`;
an empty table has no rows. Other columns take no part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Steps, read

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
WIDTH, BITS = 16, 4
#: Words of the id bitmaps are numbered doc_id >> 6, from -2^57; null ids share a word of their own before all others.
NO_ID = -(2**57) - 1
#: From words to 2^16 ids, 2^32 ids, 2^48 ids.
DIRECTORY = (10, 16, 16)
#: Copies that one row stands for are expanded in two steps of at most this many.
EXPANDED = 1_000_000


def hashed(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    value = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf(**changed: Column) -> Column:
    """The digest of a row, with other values for the columns named."""
    return hashed(*[field(changed.get(name, F.col(name))) for name in FIELDS])


def leaves(docs: DataFrame, claimed: Column) -> DataFrame:
    """Each row's group (its source, in an order that puts null first), bitmap word and bit, leaf, and claimed digest."""
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("grp"),
        F.coalesce(F.shiftright(doc_id, 6), F.lit(NO_ID)).alias("word"),
        F.coalesce(doc_id.bitwiseAND(63), F.lit(0)).cast("int").alias("bit"),
        leaf().alias("leaf"),
        claimed.alias("claimed"),
    )


def _before(n: Column, order: str, *within: str) -> Column:
    """Sum over the entries before this one."""
    frame = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(n).over(frame), F.lit(0))


def directory(words: DataFrame) -> DataFrame:
    """Each word with the rows of its source before it (`before`) and in all (`size`)."""
    steps = [words.select("grp", F.col("word").alias("key"), "n")]
    for shift in DIRECTORY:
        steps.append(steps[-1].groupBy("grp", F.shiftright("key", shift).alias("key")).agg(F.sum("n").alias("n")))
    sizes = steps[-1].groupBy("grp").agg(F.sum("n").alias("size"))
    above = steps[-1].select("grp", "key", _before(F.col("n"), "key", "grp").alias("before")).join(sizes, "grp")
    for entries, shift in zip(reversed(steps[:-1]), reversed(DIRECTORY)):
        entries = entries.withColumn("over", F.shiftright("key", shift))
        here = entries.withColumn("inside", _before(F.col("n"), "key", "grp", "over"))
        above = here.join(above.withColumnRenamed("key", "over"), ["grp", "over"]).select("grp", "key", (F.col("before") + F.col("inside")).alias("before"), "size")
    return words.join(above.withColumnRenamed("key", "word"), ["grp", "word"])


def _repeated(rows: DataFrame, steps: Steps) -> DataFrame:
    """Places of rows whose word holds repeated ids."""
    rows = rows.groupBy("grp", "word", "bit", "leaf").agg(
        F.count("*").alias("copies"), F.first("claimed").alias("claimed"), F.first("before").alias("before"), F.first("size").alias("size")
    )
    rows = steps.keep(rows.withColumn("prefix", F.substring("leaf", 1, 4)), "repeated")
    cells = rows.groupBy("grp", "word", "bit", "prefix").agg(F.sum("copies").alias("n"))
    ids = cells.groupBy("grp", "word", "bit").agg(F.sum("n").alias("n"))
    ids = ids.select("grp", "word", "bit", _before(F.col("n"), "bit", "grp", "word").alias("by_id"))
    cells = cells.select("grp", "word", "bit", "prefix", _before(F.col("n"), "prefix", "grp", "word", "bit").alias("by_cell"))
    inside = rows.withColumn("inside", _before(F.col("copies"), "leaf", "grp", "word", "bit", "prefix"))
    placed = inside.join(cells, ["grp", "word", "bit", "prefix"]).join(ids, ["grp", "word", "bit"])
    first = F.col("before") + F.col("by_id") + F.col("by_cell") + F.col("inside")
    some = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(EXPANDED).cast("long")))
    spread = placed.withColumn("first", first).withColumn("from", some).repartition("grp", "word", "bit", "leaf", "from")
    upto = F.least(F.col("from") + EXPANDED, F.col("copies")) - 1
    return spread.withColumn("at", F.explode(F.sequence("from", upto))).select("grp", (F.col("first") + F.col("at")).alias("place"), "size", "word", "bit", "leaf", "claimed")


def placed(found: DataFrame, steps: Steps) -> DataFrame:
    """Each leaf with its place in its source and the source's size."""
    bits = F.expr("bit_or(shiftleft(1L, bit))")
    words = steps.keep(found.groupBy("grp", "word").agg(bits.alias("bits"), F.count("*").alias("n")), "words")
    rows = steps.keep(found.join(directory(words), ["grp", "word"]), "ranked")
    whole = F.col("n") == F.bit_count("bits")
    rank = F.expr("before + bit_count(bits & ~shiftleft(-1L, bit))")
    single = rows.where(whole).select("grp", rank.alias("place"), "size", "word", "bit", "leaf", "claimed")
    return single if rows.where(~whole).isEmpty() else single.unionByName(_repeated(rows.where(~whole), steps))


def _digests(slots: Column) -> Column:
    return F.transform(slots, lambda s: s["digest"])


class Tree:
    """The levels of the trees of all groups: runs of up to 16 nodes, stored level by level."""

    def __init__(self, nodes: DataFrame, steps: Steps, label: str, carried: tuple[str, ...] = ()):
        """``nodes``: grp, place, size (nodes of the group at this level), digest, and columns that leaves carry."""
        largest = nodes.agg(F.max("size")).first()[0] or 0
        self.carried, self.runs, tops = carried, [], []
        while True:
            tops.append(nodes.where("size = 1").select("grp", "digest", F.lit(len(self.runs)).alias("level")))
            if not self.runs:
                self.lone = nodes.where("size = 1")
            if largest <= 1:
                break
            slot = F.struct(F.col("place").bitwiseAND(WIDTH - 1).cast("int").alias("slot"), "digest", *(carried if not self.runs else ()))
            runs = nodes.where("size > 1").groupBy("grp", F.shiftright("place", BITS).alias("run")).agg(F.sort_array(F.collect_list(slot)).alias("slots"), F.first("size").alias("size"))
            runs = steps.keep(runs, f"{label}-{len(self.runs)}")
            self.runs.append(runs)
            up = F.expr(f"(size + {WIDTH - 1}) div {WIDTH}")
            nodes = runs.select("grp", F.col("run").alias("place"), up.alias("size"), F.sha2(F.array_join(_digests(F.col("slots")), ""), 256).alias("digest"))
            largest = -(-largest // WIDTH)
        self.tops = tops[0]
        for more in tops[1:]:
            self.tops = self.tops.unionByName(more)

    def proofs(self, tops: DataFrame) -> DataFrame:
        """All nodes of the lowest level with `path`: the digests left and right of it, level by level, up to the root.

        ``tops`` gives each group's path from its top node and columns that all its nodes take over.
        """
        extra = [c for c in tops.columns if c not in ("grp", "level", "path", "digest")]
        above = None
        for level in range(len(self.runs) - 1, -1, -1):
            starts = tops.where(F.col("level") == level + 1).select("grp", F.lit(0).cast("long").alias("run"), "path", *extra)
            above = starts if above is None else starts.unionByName(above.withColumnRenamed("place", "run").select("grp", "run", "path", *extra))
            nodes = self.runs[level].join(above, ["grp", "run"]).select("*", F.posexplode("slots").alias("pos", "node")).withColumn("all", _digests(F.col("slots")))
            side = lambda start, length: F.array_join(F.slice("all", start, length), "")
            own = F.struct(side(F.lit(1), F.col("pos")).alias("left"), side(F.col("pos") + 2, F.lit(WIDTH)).alias("right"))
            held = [F.col(f"node.{c}").alias(c) for c in ("digest", *(self.carried if level == 0 else ()))]
            above = nodes.select("grp", (F.col("run") * WIDTH + F.col("pos")).alias("place"), *held, F.concat(F.array(own), "path").alias("path"), *extra)
        lone = self.lone.select("grp", "place", "digest", *self.carried).join(tops.where("level = 0").select("grp", "path", *extra), "grp")
        return lone if above is None else above.unionByName(lone)


@dataclass(frozen=True)
class Manifest:
    """`leaves`: doc_id, leaf, claimed, subroot, path (structs of left and right, lowest level first); the root digest."""

    leaves: DataFrame
    root: str | None


def _ranked(tops: DataFrame, steps: Steps) -> DataFrame:
    """Subroots with their place among all sources, by a distributed sort and the sizes of its partitions."""
    ordered = steps.keep(tops.orderBy("grp").withColumn("at", F.monotonically_increasing_id()), "subroots")
    part = F.shiftright("at", 33)
    parts = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    total = Window.partitionBy(F.lit(0))  # one row for each partition of the sort
    parts = parts.select("part", _before(F.col("n"), "part", F.lit(0)).alias("earlier"), F.sum("n").over(total).alias("size"))
    place = F.col("earlier") + F.col("at").bitwiseAND(2**33 - 1)
    return ordered.withColumn("part", part).join(F.broadcast(parts), "part").select("grp", "digest", "level", place.alias("place"), "size")


def manifest(docs: DataFrame, claimed: Column | None = None) -> Manifest:
    """The manifest of a table. ``claimed`` is the digest of another version of a row, to be checked against the proof
    of the original; null where there is none."""
    steps = Steps(docs.sparkSession, "manifest")
    found = steps.keep(leaves(docs, F.lit(None).cast("string") if claimed is None else claimed), "leaves")
    nodes = placed(found, steps).withColumnRenamed("leaf", "digest")
    tree = Tree(nodes, steps, "level", ("word", "bit", "claimed"))
    subroots = steps.keep(_ranked(tree.tops, steps), "ranked-subroots")
    crown = Tree(subroots.select(F.lit("").alias("grp"), "place", "size", "digest", F.col("grp").alias("source"), F.col("level").alias("depth")), steps, "crown", ("source", "depth"))
    root = crown.tops.first()
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    tops = crown.proofs(crown.tops.select("grp", "level", nothing.alias("path")))
    tops = tops.select(F.col("source").alias("grp"), F.col("depth").alias("level"), F.col("digest").alias("subroot"), "path")
    doc_id = F.when(F.col("word") != NO_ID, F.shiftleft("word", 6).bitwiseOR(F.col("bit").cast("long")))
    rows = tree.proofs(tops).select(doc_id.alias("doc_id"), F.col("digest").alias("leaf"), "claimed", "subroot", "path")
    return Manifest(rows, root["digest"] if root else None)


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf digest leads to along its proof."""
    return F.aggregate(path, digest, lambda node, level: hashed(level["left"], node, level["right"]))


def op11_merkle_manifest(spark, sf_dir):
    docs, lower = read(spark, sf_dir, "documents"), F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0
    made = manifest(docs, F.when(tampered, leaf(text=lower)))
    siblings = F.array_join(F.transform("path", lambda level: F.concat(level["left"], level["right"])), "")
    rows = made.leaves.select("doc_id", "leaf", "subroot", F.lit(made.root).alias("root"), F.sha2(siblings, 256).alias("proof_sha256"),
                              folded(F.coalesce("claimed", "leaf"), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


OP11_SQL = """
WITH RECURSIVE lowered AS (
    SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_text,
        xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
            lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) AS crc
    FROM documents
), fields AS (
    SELECT doc_id, source, crc,
        concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
            coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
        coalesce(strlen(text) || ':' || text, '-') AS body, coalesce(strlen(lower_text) || ':' || lower_text, '-') AS lower_body
    FROM lowered
), leaves AS (
    SELECT doc_id, coalesce('=' || source, '') AS grp, sha256(head || body) AS leaf,
        CASE WHEN crc % 5 = 0 THEN sha256(head || lower_body) ELSE sha256(head || body) END AS claimed
    FROM fields
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY grp) AS size FROM leaves
), nodes AS (
    SELECT grp, 0 AS level, place, size, leaf AS digest FROM placed
    UNION ALL
    SELECT grp, level + 1, place // 16, (size + 15) // 16, sha256(string_agg(digest, '' ORDER BY place))
    FROM nodes WHERE size > 1 GROUP BY grp, level, place // 16, size
), subroots AS (
    SELECT grp, digest, row_number() OVER (ORDER BY grp) - 1 AS place, count(*) OVER () AS size FROM nodes WHERE size = 1
), crown AS (
    SELECT 0 AS level, place, size, digest FROM subroots
    UNION ALL
    SELECT level + 1, place // 16, (size + 15) // 16, sha256(string_agg(digest, '' ORDER BY place))
    FROM crown WHERE size > 1 GROUP BY level, place // 16, size
), runs AS (
    SELECT grp, level, place // 16 AS run, list(digest ORDER BY place) AS digests FROM nodes WHERE size > 1 GROUP BY ALL
), crown_runs AS (
    SELECT level, place // 16 AS run, list(digest ORDER BY place) AS digests FROM crown WHERE size > 1 GROUP BY ALL
), walk AS (
    SELECT grp, place AS leaf_place, 0 AS level, place, size, claimed AS node, '' AS proof FROM placed
    UNION ALL
    SELECT w.grp, leaf_place, w.level + 1, place // 16, (size + 15) // 16,
        sha256(array_to_string(list_concat(digests[:place % 16], [node], digests[place % 16 + 2:]), '')),
        proof || array_to_string(list_concat(digests[:place % 16], digests[place % 16 + 2:]), '')
    FROM walk w JOIN runs r ON w.grp = r.grp AND w.level = r.level AND w.place // 16 = r.run
), upper AS (
    SELECT w.grp, leaf_place, 0 AS level, s.place, s.size, node, proof FROM walk w JOIN subroots s ON w.grp = s.grp WHERE w.size = 1
    UNION ALL
    SELECT u.grp, leaf_place, u.level + 1, place // 16, (size + 15) // 16,
        sha256(array_to_string(list_concat(digests[:place % 16], [node], digests[place % 16 + 2:]), '')),
        proof || array_to_string(list_concat(digests[:place % 16], digests[place % 16 + 2:]), '')
    FROM upper u JOIN crown_runs r ON u.level = r.level AND u.place // 16 = r.run
)
SELECT p.doc_id, p.leaf, s.digest AS subroot, c.digest AS root, sha256(u.proof) AS proof_sha256, u.node AS folded_root, u.node = c.digest AS verified
FROM upper u JOIN placed p ON u.grp = p.grp AND u.leaf_place = p.place JOIN subroots s ON u.grp = s.grp JOIN crown c ON c.size = 1
WHERE u.size = 1
"""
