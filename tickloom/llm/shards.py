"""A uniform shuffle of a table into shards whose sizes are exact.

How many rows each input partition gives to each shard is drawn first: the counts of a
uniform shuffle follow a multivariate hypergeometric law with the partition sizes as rows
and the shard sizes as columns. Then every partition permutes its rows and deals them out
by those counts, rows are exchanged, and every shard permutes what it got.

The driver draws the matrix for groups of partitions; tasks draw the partitions of a group.
Rows never meet in one place: both permutations are computed for each row from its number
(a keyed permutation of 0..n-1), so a task holds one Arrow batch, and a row that is worked
out again after a loss lands where it did before. Rows get their numbers in a written table.

Cases: all columns are kept as they are, nulls too; equal rows are rows of their own; an
empty table gives an empty one; shards may be more than rows, then some stay empty. Columns
called like a result (``shard``, ``slot``) are replaced.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from tickloom.llm.frames import free_name, utf8_bytes, whole
from tickloom.workspace import settle

SHARDS = 24
SEED = 20240
# Partitions whose counts one task draws.
GROUP = 256
# Rows of a shard that are exchanged to one task, the bytes they have on average, and how
# many such tasks there are at most; beyond, blocks get larger.
BLOCK_ROWS = 50_000
BLOCK_BYTES = 8 << 20
MOST_BLOCKS = 200_000


def hypergeometric(random: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` from ``good`` and ``bad`` are good, at any size.

    Inversion over all values within some forty standard deviations of the mode, whose
    probabilities follow from each other by exact ratios; what lies beyond is less than
    a double can tell from nothing.
    """
    least, most = max(0, draws - bad), min(draws, good)
    if least == most:
        return least
    total = good + bad
    mode = min(max((draws + 1) * (good + 1) // (total + 2), least), most)
    spread = (draws * (good / total) * (bad / total) * ((total - draws) / max(1, total - 1))) ** 0.5
    reach = int(40 * spread) + 40
    values = np.arange(max(least, mode - reach), min(most, mode + reach) + 1)
    k = values[:-1].astype(float)
    log_ratio = np.log((good - k) / (k + 1)) + np.log((draws - k) / (bad - draws + k + 1))
    log_mass = np.concatenate([[0.0], np.cumsum(log_ratio)])
    mass = np.exp(log_mass - log_mass.max())
    at = np.searchsorted(np.cumsum(mass), random.random() * mass.sum(), side="right")
    return int(values[min(at, len(values) - 1)])


def draw_counts(rows: list[int], quotas: list[int], random: np.random.Generator) -> np.ndarray:
    """Rows each source gives to each shard: sources add up to ``rows``, shards to ``quotas``."""
    left, result = list(quotas), np.zeros((len(rows), len(quotas)), np.int64)
    for i, need in enumerate(rows):
        rest = sum(left)
        for j in range(len(left)):
            rest -= left[j]
            taken = hypergeometric(random, left[j], rest, need)
            result[i, j] = taken
            left[j] -= taken
            need -= taken
    return result


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Where ``index`` lands in a keyed random permutation of 0..size-1, for each row.

    A Feistel network over the next even number of bits; results outside are sent
    through it again until they are inside.
    """
    bits = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    value, key = index.astype(np.uint64), key.astype(np.uint64)
    todo = np.arange(len(value))
    while len(todo):
        b, m, k = bits[todo], mask[todo], key[todo]
        left, right = value[todo] >> b, value[todo] & m
        for step in range(6):
            left, right = right, left ^ (_mixed(right + (k ^ np.uint64(step * 0x9E3779B9))) & m)
        value[todo] = (left << b) | right
        todo = todo[value[todo] >= size[todo].astype(np.uint64)]
    return value.astype(np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash (the finaliser of splitmix64; its constants are fixed values)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def communication_matrix(counts: DataFrame, pid: str, rows: str, shards: int, seed: int, group: int = GROUP) -> tuple[DataFrame, list[int]]:
    """For each partition its rows for each shard, and how many rows of each shard come
    from partitions before it; and the size of each shard."""
    spark = counts.sparkSession
    in_group = F.floor(F.col(pid) / group).cast("int").alias("in_group")
    grouped = counts.groupBy(in_group).agg(F.sum(rows).alias("rows")).orderBy("in_group").collect()
    total = sum(g["rows"] for g in grouped)
    quotas = [total // shards + (i < total % shards) for i in range(shards)]
    matrix = draw_counts([g["rows"] for g in grouped], quotas, np.random.default_rng([seed, shards]))
    before = np.cumsum(matrix, axis=0) - matrix
    schema = "in_group int, quotas array<bigint>, before array<bigint>"
    drawn = [(g["in_group"], matrix[i].tolist(), before[i].tolist()) for i, g in enumerate(grouped)]
    groups = spark.createDataFrame(drawn, schema)
    members = counts.select(in_group, F.col(pid).alias("member"), F.col(rows).alias("rows"))

    def of_group(key: tuple, parts: pd.DataFrame, quota: pd.DataFrame) -> pd.DataFrame:
        parts = parts.sort_values("member")
        random = np.random.default_rng([seed, shards, 1 + int(key[0])])
        own = draw_counts(parts["rows"].tolist(), list(map(int, quota["quotas"][0])), random)
        first = np.asarray(quota["before"][0]) + np.cumsum(own, axis=0) - own
        return pd.DataFrame({"member": parts["member"], "quotas": own.tolist(), "before": first.tolist()})

    both = members.groupBy("in_group").cogroup(groups.groupBy("in_group"))
    return both.applyInPandas(of_group, "member int, quotas array<bigint>, before array<bigint>"), quotas


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row has."""
    sizes = [F.lit(8).cast("bigint")]
    for field in df.schema:
        if isinstance(field.dataType, (StringType, BinaryType)):
            sizes.append(F.coalesce(F.octet_length(F.col(quoted(field.name))), F.lit(0)))
        elif isinstance(field.dataType, (ArrayType, MapType, StructType)):
            sizes.append(F.coalesce(F.octet_length(F.col(quoted(field.name)).cast("string")), F.lit(0)))
        else:
            sizes.append(F.lit(8))
    return reduce(Column.__add__, sizes)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def exact_shuffle(
    df: DataFrame, shards: int = SHARDS, seed: int = SEED, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Add ``shard`` and ``slot``: a uniform shuffle into shards whose sizes differ by one
    row at most, with slots from 0 without gaps. Rows come grouped by shard and block of
    slots, in order, each block in a task of its own. A block has ``block_rows`` rows, or fewer where rows are long: since
    the shuffle is uniform, blocks of as many rows have about as many bytes."""
    df = df.drop("shard", "slot")
    pid, index = free_name(df, "input_partition"), free_name(df, "input_row")
    # Both halves of this number are fixed once the table is written.
    low = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    numbered = settle(df.withColumns({pid: F.spark_partition_id(), index: low}), "shuffle")
    counts = numbered.groupBy(pid).agg(F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(df)).alias("bytes"))
    counts = settle(counts, "counts")
    held = counts.agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")).first()
    if held["rows"]:
        block_rows = max(1, min(block_rows, block_bytes * held["rows"] // held["bytes"]))
        block_rows = max(block_rows, held["rows"] // MOST_BLOCKS)
    matrix, quotas = communication_matrix(counts, pid, "rows", shards, seed)
    member, own, before, place = (free_name(df, x) for x in ("member", "quotas", "before", "place"))
    dealt = numbered.join(settle(matrix, "matrix").toDF(member, own, before), F.col(pid) == F.col(member))
    sizes = np.array(quotas, np.int64)

    @F.arrow_udf("struct<shard:int,slot:bigint>")
    def placed(partition: pa.Array, row: pa.Array, quotas_of: pa.Array, before_of: pa.Array) -> pa.Array:
        p, i = (np.asarray(x, np.int64) for x in (partition, row))
        q = np.asarray(quotas_of.flatten(), np.int64).reshape(len(p), -1)
        b = np.asarray(before_of.flatten(), np.int64).reshape(len(p), -1)
        upto = np.cumsum(q, axis=1)
        local = permuted(i, upto[:, -1], _mixed((p + (seed << 20)).astype(np.uint64)))
        shard = (local[:, None] >= upto).sum(axis=1)
        at = np.arange(len(p))
        arrived = b[at, shard] + local - (upto - q)[at, shard]
        slot = permuted(arrived, sizes[shard], _mixed((shard + (seed << 21) + 1).astype(np.uint64)))
        return pa.StructArray.from_arrays([pa.array(shard, pa.int32()), pa.array(slot, pa.int64())], ["shard", "slot"])

    put = dealt.withColumn(place, placed(F.col(pid), F.col(index), F.col(own), F.col(before)))
    put = put.select(*df.columns, F.col(place)["shard"].alias("shard"), F.col(place)["slot"].alias("slot"))
    blocks = max(1, -(-max(quotas) // block_rows))
    block = F.col("shard") * blocks + F.floor(F.col("slot") / block_rows).cast("int")
    return put.repartitionById(shards * blocks, block).sortWithinPartitions("shard", "slot")


def write_shards(df: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Shuffle and write one folder for each shard, files in the order of slots."""
    exact_shuffle(df, shards, seed).write.partitionBy("shard").parquet(path)


def text_facts(key: str = "doc_id", text: str = "text") -> list[Column]:
    """Key, size (bytes of the text and 8 more) and CRC-32 of the text of each row."""
    crc = F.crc32(whole(text).cast("binary"))
    return [F.col(key), (utf8_bytes(text) + 8).alias("size"), crc.alias("text_crc32")]


def placed_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """Where each document goes, by the law of equal counts: the documents are shuffled,
    and what is told about a text is taken from the shuffled rows."""
    put = exact_shuffle(docs, shards)
    return put.select(
        *text_facts(key, text), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
