"""A Merkle manifest of a table: sibling-shift self-joins, level by level.

Leaves are digests of whole rows. A group's leaves are put in order by one range partitioning of
digests and keys (hot groups are cut like any other) and numbered from counts by partition. Then
every level is joined with itself on computed sibling indices, index XOR 1 for a binary tree, else
one join a slot offset; the rows of slot zero emit the parents. The groups' roots are the leaves of
a second tree. Paths go down the same way: a node's path is its own siblings and its parent's path,
one equijoin a level, so that 2 n rows are joined for n leaves instead of n rows at every level.

H is the lower-case hex sha256 of its inputs one after the other, digests as hex text; tables hold
digests as 32 bytes. Each level is written to the shared folder, as it is read twice; only the
number of levels comes to the driver.

Cases: null is "-" in a leaf, an empty text "0:"; null groups are one group, first in order; null
keys come first; leaves with equal keys are ordered by digest, so that repeated rows have one
result, whichever of them stands first; an empty table gives no rows. Only the named columns are
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import durable, pick

# Fixed values of the contract: the columns of a leaf, in order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 2
WRITTEN_LEVELS = 4


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def field(value: Column) -> Column:
    """The value as bytes counted, a colon and the bytes; null as a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def numbered(rows: DataFrame, group: str | None, keys: list[str]) -> DataFrame:
    """rows with at (place in the group, from 0) and n (rows of the group), as a written table.

    Equal rows are told apart by where they were read, so that they, too, spread over partitions.
    """
    names = rows.columns
    order = [c for c in (group, *keys) if c] + ["_read"]
    by = [F.col(c).asc_nulls_first() for c in order]
    placed = durable(
        rows.withColumn("_read", F.monotonically_increasing_id())
        .repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .select(*names, F.monotonically_increasing_id().alias("_at"))
    )
    # One row a partition and group; partitions hold ranges, so there are few groups in most.
    part = F.shiftright("_at", 33)
    whose = F.col(group) if group else F.lit(0)
    counts = placed.groupBy(part.alias("_part"), whose.alias("_group")).agg(
        F.min("_at").alias("_first"), F.count("*").alias("_n")
    )
    own = Window.partitionBy("_group")
    before = own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = durable(
        counts.select(
            "_part",
            F.col("_group").alias("_whose"),
            (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
            F.sum("_n").over(own).alias("n"),
        )
    )
    return placed.join(
        counts, (part == F.col("_part")) & whose.eqNullSafe(F.col("_whose"))
    ).select(*names, (F.col("_at") + F.col("_shift")).alias("at"), "n")


def levels(leaves: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """The tables of all levels, leaves (g, at, n, digest and others) first.

    A node has g, at, n, digest, before and after: its siblings with lower and higher slots, their
    digests one after the other. Roots have neither and appear in the level that they belong to.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    done = []
    nodes = leaves
    while True:
        slot = F.pmod("at", F.lit(fanout))
        if fanout == 2:
            offsets = {1: F.col("at").bitwiseXOR(F.lit(1))}
        else:
            offsets = {
                o: F.col("at") - slot + F.pmod(slot + F.lit(o), F.lit(fanout)) for o in range(1, fanout)
            }
        joined = nodes
        for o, index in offsets.items():
            # A row is moved to the place of the sibling that looks for it.
            back = F.col("at").bitwiseXOR(F.lit(1)) if fanout == 2 else (
                F.col("at") - slot + F.pmod(slot - F.lit(o), F.lit(fanout))
            )
            other = nodes.where("n > 1").select(
                F.col("g").alias("_g"), back.alias("_at"), F.struct(slot.alias("slot"), F.col("digest")).alias(f"_s{o}")
            )
            joined = joined.join(
                other, (F.col("g") == F.col("_g")) & (F.col("at") == F.col("_at")), "left"
            ).drop("_g", "_at")
        found = F.array_sort(F.array_compact(F.array(*[f"_s{o}" for o in offsets])))

        def side(keep) -> Column:
            return F.unhex(F.array_join(F.transform(F.filter(found, keep), lambda x: hexed(x["digest"])), ""))

        table = durable(
            joined.select(
                *nodes.columns,
                side(lambda x: x["slot"] < slot).alias("before"),
                side(lambda x: x["slot"] > slot).alias("after"),
            )
        )
        done.append(table)
        if most <= 1:
            return done
        # The rows of slot zero emit the parents.
        nodes = table.where((F.col("n") > 1) & (slot == 0)).select(
            "g",
            F.floor(F.col("at") / fanout).cast("bigint").alias("at") if fanout != 2 else F.shiftright("at", 1).alias("at"),
            F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"),
            F.unhex(F.sha2(F.concat(hexed(F.col("digest")), hexed(F.col("after"))), 256)).alias("digest"),
        )
        most = -(-most // fanout)


STEP = "array<struct<before:binary,after:binary>>"


def with_paths(tables: list[DataFrame], roots: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The leaves with what roots (g, level, path and others) hold for their group, path preceded
    by the leaf's own siblings of every level."""
    extra = [c for c in roots.columns if c not in ("g", "level")]
    paths = None
    for level in range(len(tables) - 1, -1, -1):
        table = tables[level]
        keep = table.columns if level == 0 else ["g", "at", "before", "after"]
        tops = roots.where(F.col("level") == level).withColumnRenamed("g", "_g")
        here = (
            table.where("n = 1").select(*keep).join(tops.drop("level"), F.col("g") == F.col("_g")).drop("_g")
        )
        if paths is not None:
            parent = paths.select(
                F.col("g").alias("_g"), F.col("at").alias("_at"), *extra
            )
            below = table.where("n > 1").select(*keep).join(
                parent,
                (F.col("g") == F.col("_g")) & (F.expr(f"at div {fanout}") == F.col("_at")),
            ).drop("_g", "_at")
            step = F.array(F.struct("before", "after"))
            below = below.withColumn("path", F.concat(step, F.col("path")))
            here = below.unionByName(here)
        # Written now and then, so that no plan grows with the height of the tree.
        paths = durable(here) if level and level % WRITTEN_LEVELS == 0 else here
    return paths


def manifest(
    docs: DataFrame,
    group: str = "lang",
    key: str = "doc_id",
    columns: tuple[str, ...] = LEAF_COLUMNS,
    tampered: dict[str, Column] | None = None,
    fanout: int = FANOUT,
) -> DataFrame:
    """A row a row of docs: key, group, leaf, other, subroot, root (32 bytes each) and path.

    path lists a leaf's siblings from its own level to the root; other is the leaf with the values
    that tampered gives for columns (null where they do not differ).
    """
    rows = pick(docs, *dict.fromkeys((group, key, *columns)))
    own = leaf(*[F.col(c) for c in columns])
    changed = F.lit(None).cast("binary")
    if tampered:
        differs = F.lit(False)
        for c, value in tampered.items():
            differs = differs | ~value.eqNullSafe(F.col(c).cast("string"))
        changed = F.when(differs, leaf(*[tampered.get(c, F.col(c)) for c in columns]))
    leaves = numbered(
        rows.select(
            F.col(key).alias("key"), F.col(group).alias("group"), own.alias("digest"), changed.alias("other")
        ),
        "group",
        ["key", "digest"],
    )
    leaves = durable(leaves)
    groups = leaves.groupBy("group").agg(F.first("n").alias("size"))
    groups = durable(numbered(groups, None, ["group"]).select("group", "size", F.col("at").alias("g")))
    leaves = leaves.join(
        groups.select("g", F.col("group").alias("_group")), F.col("group").eqNullSafe(F.col("_group"))
    ).drop("_group")
    tables = levels(leaves, fanout)

    tops = None
    for level, table in enumerate(tables):
        ends = table.where("n = 1").select("g", F.col("digest"), F.lit(level).alias("level"))
        tops = ends if tops is None else tops.unionByName(ends)
    tops = durable(tops)
    # The second tree: all groups' roots are its leaves, in the order of the groups.
    upper = levels(
        tops.select(
            F.lit(0).cast("bigint").alias("g"), F.col("g").alias("at"), F.lit(groups.count()).alias("n"), "digest", "level",
            F.col("g").alias("whose"),
        ),
        fanout,
    )
    root = upper[-1].where("n = 1").select(
        "g", F.lit(len(upper) - 1).alias("level"), F.col("digest").alias("root"),
        F.array().cast(STEP).alias("path"),
    )
    known = durable(
        with_paths([upper[0].withColumnRenamed("level", "height"), *upper[1:]], root, fanout).select(
            F.col("whose").alias("g"), F.col("height").alias("level"), F.col("digest").alias("subroot"), "root", "path"
        )
    )
    return with_paths(tables, known, fanout).select(
        "key", "group", F.col("digest").alias("leaf"), "other", "subroot", "root", "path"
    )


def proof(path: Column) -> Column:
    """H of all siblings of a path, as hex text."""
    return F.sha2(
        F.array_join(F.transform(path, lambda s: F.concat(hexed(s["before"]), hexed(s["after"]))), ""), 256
    )


def folded(start: Column, path: Column) -> Column:
    """The root, as hex text, that a leaf and its siblings lead to."""
    return F.aggregate(
        path,
        hexed(start),
        lambda value, s: F.sha2(F.concat(hexed(s["before"]), value, hexed(s["after"])), 256),
    )


def proofs(docs: DataFrame) -> DataFrame:
    """The contract's row a document, with n_chars one higher where 7 divides crc32 of the id."""
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.when(struck, (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string"))
    rows = manifest(
        docs, tampered={"n_chars": F.coalesce(more, F.col("n_chars").cast("string"))}
    )
    fold = folded(F.coalesce("other", "leaf"), F.col("path"))
    return rows.select(
        F.col("key").alias("doc_id"),
        hexed(F.col("leaf")).alias("leaf"),
        hexed(F.col("subroot")).alias("subroot"),
        hexed(F.col("root")).alias("root"),
        proof(F.col("path")).alias("proof_sha256"),
        fold.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


MERKLE_SQL = """
WITH RECURSIVE table_ AS (
  SELECT i, list_reduce([CAST(i AS BIGINT), 1, 1, 1, 1, 1, 1, 1, 1],
                        LAMBDA c, b: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) AS v
  FROM range(256) t(i)
), crcs AS (SELECT list(v ORDER BY i) AS t FROM table_),
f AS (
  SELECT doc_id, lang, n_chars AS c,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
         || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(text) || ':' || text, '-') AS tail,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
               list_transform(string_split(CAST(doc_id AS VARCHAR), ''), LAMBDA x: CAST(ascii(x) AS BIGINT))),
             LAMBDA a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS crc
  FROM documents, crcs
), d AS (
  SELECT doc_id, lang,
         sha256(head || coalesce(strlen(CAST(c AS VARCHAR)) || ':' || c, '-') || tail) AS leaf,
         sha256(head || coalesce(strlen(CAST(x AS VARCHAR)) || ':' || x, '-') || tail) AS other
  FROM (SELECT *, CASE WHEN crc % 7 = 0 THEN CAST(c AS HUGEINT) + 1 ELSE c END AS x FROM f)
), langs AS (
  SELECT lang, row_number() OVER (ORDER BY lang COLLATE C NULLS FIRST) - 1 AS g FROM (SELECT DISTINCT lang FROM d)
), leaves AS (
  SELECT d.*, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY g) AS n
  FROM d JOIN langs ON d.lang IS NOT DISTINCT FROM langs.lang
), nodes AS (
  SELECT 0 AS level, g, pos, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT level + 1, g, pos // 2, (n + 1) // 2, sha256(digest || coalesce(other, ''))
  FROM (SELECT *, lead(digest) OVER (PARTITION BY level, g ORDER BY pos) AS other FROM nodes WHERE n > 1)
  WHERE pos % 2 = 0
), tops AS (
  SELECT g, level AS height, digest FROM nodes WHERE n = 1
), upper_ AS (
  SELECT 0 AS level, g AS pos, count(*) OVER () AS n, digest FROM tops
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(digest || coalesce(other, ''))
  FROM (SELECT *, lead(digest) OVER (PARTITION BY level ORDER BY pos) AS other FROM upper_ WHERE n > 1)
  WHERE pos % 2 = 0
), folds AS (
  SELECT g, pos, CAST(0 AS INTEGER) AS level, false AS above, g AS g0, pos AS pos0, other AS value, '' AS path FROM leaves
  UNION ALL
  SELECT CASE WHEN top THEN 0 ELSE g END, CASE WHEN top THEN g ELSE pos // 2 END,
         CASE WHEN top THEN 0 ELSE level + 1 END, above OR top, g0, pos0,
         CASE WHEN top THEN value WHEN pos % 2 = 0 THEN sha256(value || coalesce(sibling, ''))
              ELSE sha256(sibling || value) END,
         CASE WHEN top THEN path ELSE path || coalesce(sibling, '') END
  FROM (SELECT f.*, NOT above AND f.level = tops.height AS top, s.digest AS sibling
        FROM folds f LEFT JOIN tops ON NOT f.above AND f.g = tops.g
        LEFT JOIN (SELECT false AS up, level, g, pos, digest FROM nodes
                   UNION ALL SELECT true, level, 0, pos, digest FROM upper_) s
          ON s.up = f.above AND s.level = f.level AND s.g = f.g AND s.pos = xor(f.pos, 1)
        WHERE NOT f.above OR f.level < (SELECT max(level) FROM upper_))
)
SELECT doc_id, leaf, tops.digest AS subroot, r.digest AS root, sha256(path) AS proof_sha256,
       value AS folded_root, value = r.digest AS verified
FROM folds JOIN leaves ON g0 = leaves.g AND pos0 = leaves.pos JOIN tops ON tops.g = g0,
     (SELECT digest FROM upper_ WHERE n = 1) r
WHERE folds.above AND folds.level = (SELECT max(level) FROM upper_)
"""
