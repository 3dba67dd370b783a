"""Sharding by histogram sort: exact counts below candidate key boundaries, refined until splitters fit, then one exchange.

Each row gets a key that orders equal texts next to each other: a hash of the text, one of the
id, and a running number that parts rows equal in both. Every round groups the rows below the
candidate boundaries (prefixes of the key) and sums their bytes and rows exactly; only the few
prefixes in which a splitter still lies are cut finer in the next round. With the splitters known,
the rows move once, to pieces, each a task; shards are runs of pieces.

Only boundaries of shards are refined to the tolerance. Those of pieces take the nearest edge at hand and are refined
only in a prefix that holds several pieces, as that of a text with very many copies does.

Native DataFrame operations only. There are PIECES pieces at most, so what reaches the driver is bounded whatever the size:
``FAN`` sums for the first round, and up to ``FAN`` in later ones for each shard and each prefix of several pieces.

Defined results: a null text counts one byte, as an empty one does; a null id hashes as such;
repeated rows are placed each on its own; an empty table gives an empty result; a column named
like an added one is replaced. More shards than rows leave some shards empty.
"""

from __future__ import annotations

import os.path
from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import bounded_rows, quoted, without
from ordermill.session import materialise

DIGITS = 3
FAN = 16**DIGITS
PIECE_BYTES = 16 << 20
PIECES = FAN // 2  # beyond this many, pieces grow


def _hex(value: Column) -> Column:
    return F.lpad(F.hex(value), 16, "0")


def size_of(text: Column) -> Column:
    """UTF-8 bytes plus one."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """``docs`` with ``_size`` and ``_key``, 48 hexadecimal digits."""
    digest = F.xxhash64(F.coalesce(quoted(text), F.lit("")))
    own = F.xxhash64(F.coalesce(quoted(doc_id).cast("string"), F.lit("")))
    return without(docs, ("_key", "_size")).select(
        "*", size_of(quoted(text)).alias("_size"),
        F.concat(_hex(digest), _hex(own), _hex(F.monotonically_increasing_id())).alias("_key"))


def _below(rows: DataFrame, open_ranges: list[tuple[str, int]]) -> list[tuple[str, int, int, str, str]]:
    """For every prefix of ``length`` digits under one of the open prefixes: rows, bytes, least and largest key."""
    schema = "head string, cuts array<struct<prefix: string, length: int>>"
    cuts: dict[str, list[dict]] = {}
    for prefix, length in open_ranges:
        cuts.setdefault(prefix[:DIGITS], []).append({"prefix": prefix, "length": length})
    heads = bounded_rows(rows.sparkSession, [{"head": h, "cuts": c} for h, c in cuts.items()], schema.replace("head string", "head: string").replace("cuts array", "cuts: array"))
    cut = F.filter("cuts", lambda c: F.col("_key").startswith(c["prefix"]))
    counted = (
        rows.select("_key", "_size", F.substring("_key", 1, DIGITS).alias("head"))
        .join(F.broadcast(heads), "head")  # one row a head, FAN at most
        .withColumn("_cut", F.explode(cut))
        .groupBy(F.expr("substring(_key, 1, _cut.length)").alias("bin"))
        .agg(F.count("*").alias("n"), F.sum("_size").alias("bytes"), F.min("_key").alias("least"), F.max("_key").alias("most"))
    )
    return sorted((r.bin, r.n, r.bytes, r.least, r.most) for r in counted.collect())


def splitters(rows: DataFrame, parts: int, tolerance: float, every: int = 1) -> tuple[list[tuple[str, int, int]], int, int]:
    """Boundaries that part the bytes of ``rows`` evenly: (key, rows below, bytes below), with the total rows and bytes.

    A boundary is right when the bytes below it are within ``tolerance`` of a part from its target,
    or when a single row spans the target; then the nearer edge of that row is taken. Of the others than each ``every``-th one
    it is enough that they lie within a part of it.
    """
    first = rows.groupBy(F.substring("_key", 1, DIGITS).alias("bin")).agg(
        F.count("*").alias("n"), F.sum("_size").alias("bytes"), F.min("_key").alias("least"), F.max("_key").alias("most"))
    bins = sorted((r.bin, r.n, r.bytes, r.least, r.most) for r in first.collect())
    total_rows, total = sum(b[1] for b in bins), sum(b[2] for b in bins)
    if not bins:
        return [], 0, 0
    part = total / parts
    # The exact ones win where two fall on one number of bytes.
    targets = {total * k // parts: tolerance * part if k % every == 0 else part for k in sorted(range(1, parts), key=lambda k: k % every == 0)}
    level = [(bins, 0, 0, sorted(targets))]
    found: dict[int, tuple[str, int, int]] = {}
    while level:
        narrower: list[tuple[str, int, int, list[int], str]] = []
        for bins, rows_before, bytes_before, wanted in level:
            edges, at, n = [], bytes_before, rows_before
            for b in bins:
                edges.append((at, n))
                at, n = at + b[2], n + b[1]
            starts = [e[0] for e in edges]
            inside: dict[int, list[int]] = {}
            for t in wanted:
                k = max(bisect_right(starts, t) - 1, 0)
                low, high = starts[k], starts[k] + bins[k][2]
                if min(t - low, high - t) <= targets[t] or bins[k][3] == bins[k][4]:
                    if t - low <= high - t:
                        found[t] = (bins[k][3], edges[k][1], low)
                    elif k + 1 < len(bins):
                        found[t] = (bins[k + 1][3], edges[k][1] + bins[k][1], high)
                    else:  # just above this bin's last row
                        found[t] = (bins[k][4] + "g", edges[k][1] + bins[k][1], high)
                else:
                    inside.setdefault(k, []).append(t)
            for k, ts in inside.items():
                shared = len(os.path.commonprefix([bins[k][3], bins[k][4]]))
                narrower.append((bins[k][3][:shared], edges[k][1], starts[k], ts, bins[k][0]))
        if not narrower:
            break
        counted = _below(rows, [(p, len(p) + DIGITS) for p, *_ in narrower])
        names = [b[0] for b in counted]
        level = [(counted[bisect_left(names, p): bisect_right(names, p + "g")], n, at, ts) for p, n, at, ts, _ in narrower]
    return [found[total * k // parts] for k in range(1, parts)], total_rows, total


def shard(docs: DataFrame, shards: int = 16, text: str = "text", doc_id: str = "doc_id", tolerance: float = 0.001,
          piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """``docs`` with ``shard`` (0 to shards - 1, near equal in bytes) and ``slot`` (gapless in each shard, from 0).

    Rows are in the order of their key. A shard is cut into pieces of about ``piece_bytes``, the unit of the
    exchange and of the sort, so no task holds a shard however large it is.
    """
    rows = materialise(keyed(docs, text, doc_id), "shard-keys")
    held = rows.agg(F.sum("_size")).first()[0] or 0
    per_shard = max(1, min(-(-held // (shards * piece_bytes)), PIECES // shards))
    cuts, _, _ = splitters(rows.select("_key", "_size"), shards * per_shard, tolerance, per_shard)
    # Boundaries, and how far each piece's first row lies from the first row of its shard.
    pieces, first_of_shard = [{"piece": 0, "key": "", "from": 0}], 0
    for k, (key, below, _) in enumerate(cuts, 1):
        if k % per_shard == 0:
            first_of_shard = below
        pieces.append({"piece": k, "key": key, "from": below - first_of_shard})
    heads = [f"{h:0{DIGITS}X}" for h in range(FAN)]
    keys = [p["key"] for p in pieces]
    listed = []
    for h in heads:  # the pieces that rows with this head can fall into
        lo, hi = bisect_right(keys, h) - 1, bisect_right(keys, h + "g")
        listed.append({"head": h, "pieces": pieces[lo:hi]})
    by_head = bounded_rows(docs.sparkSession, listed, "head: string, pieces: array<struct<piece: int, key: string, from: long>>")
    placed = (
        rows.withColumn("_head", F.substring("_key", 1, DIGITS))
        .join(F.broadcast(by_head), F.col("_head") == F.col("head"))  # FAN rows
        .withColumn("_piece", F.element_at(F.filter("pieces", lambda p: p["key"] <= F.col("_key")), -1))
        .drop("_head", "head", "pieces")
    )
    in_piece = Window.partitionBy("_piece").orderBy("_key")
    spread = without(placed, ("shard", "slot")).repartition(len(pieces), "_piece")
    numbered = spread.withColumn("slot", F.row_number().over(in_piece) - 1 + F.col("_piece.from"))
    return numbered.select(
        *[quoted(c) for c in rows.columns if c.lower() not in ("_key", "_size", "shard", "slot")],
        F.floor(F.col("_piece.piece") / per_shard).cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"))
