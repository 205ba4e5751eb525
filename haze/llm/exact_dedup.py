"""Exact dedup against a minimal perfect hash of historical digests.

The distinct digests of the history are cut into shards by digest; each shard
gets a minimal perfect hash (levels of bit arrays: a key sits at the first
level at which no other key hashes to its bit, and its slot is the rank of that
bit). Slot i holds the full 32-byte digest, the winner's locator (its id) and
the group's row count. Digests of incoming rows are combined per digest first,
then looked up in their shard: the slot's digest is compared byte by byte, a
match joins the historical group, the rest form groups of their own.

A shard holds about ``shard_keys`` distinct digests at most of the history and of
the incoming rows, whatever the copies' number (a text that a third of all rows
repeat is one key) and however unevenly the ids split the two.

Defined results: a null text counts as empty (so nulls and empty texts are one
group); rows with a null id take part, lose against any id, and a group of only
null ids has a null ``keep_id``; rows that repeat both id and text are all
``kept`` in the report (nothing tells them apart) while ``deduplicate`` keeps one
of them; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haze.llm.common import ascii_lower, fresh, written

SHARD_KEYS = 1 << 16
_GAMMA = 2  # bits of a level for each key it has to place
_GROUP = "digest binary, keep_id long, n long, n_win long"


def text_digest(text: Column) -> Column:
    """SHA-256 (32 bytes) of the text with A-Z lower-cased; null counts as empty."""
    return F.unhex(F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256))


# -- minimal perfect hash of one shard --------------------------------------

def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash of each digest (n x 4 uint64 words) for this level."""
    with np.errstate(over="ignore"):
        x = keys[:, level % 4] + np.uint64(0x9E3779B97F4A7C15) * np.uint64(level + 1)
        x ^= keys[:, (level + 1) % 4] >> np.uint64(7)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def build_mph(keys: np.ndarray) -> list[np.ndarray]:
    """Level bit arrays for distinct digests (n x 4 uint64)."""
    levels: list[np.ndarray] = []
    left = keys
    while len(left):
        size = max(_GAMMA * len(left), 64)
        at = (_mixed(left, len(levels)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        left = left[~alone[at]]
    return levels


def mph_slots(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Slot of each key; for a key outside the built set any slot, or -1."""
    slots = np.full(len(keys), -1, dtype=np.int64)
    before, left = 0, np.arange(len(keys))
    for i, bits in enumerate(levels):
        if not len(left):
            break
        rank = np.cumsum(bits) - 1
        at = (_mixed(keys[left], i) % np.uint64(len(bits))).astype(np.int64)
        hit = bits[at]
        slots[left[hit]] = before + rank[at[hit]]
        before += int(rank[-1]) + 1
        left = left[~hit]
    return slots


def _words(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 4)


def _index_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    """One shard of the history as one row: level bits and slot arrays."""
    keys = _words(pdf["digest"])
    levels = build_mph(keys)
    order = np.argsort(mph_slots(levels, keys))  # slot -> row
    slots = pdf.iloc[order]
    has_id = slots["keep_id"].notna().to_numpy()
    return pd.DataFrame([{
        "shard": int(pdf["shard"].iloc[0]),
        "level_bits": [len(b) for b in levels],
        "levels": b"".join(np.packbits(b).tobytes() for b in levels),
        "digests": b"".join(slots["digest"]),
        "locators": slots["keep_id"].fillna(0).astype("int64").to_numpy().tobytes(),
        "located": np.packbits(has_id).tobytes(),
        "counts": slots["n"].astype("int64").to_numpy().tobytes(),
        "win_counts": slots["n_win"].astype("int64").to_numpy().tobytes(),
    }])


_INDEX = ("shard long, level_bits array<long>, levels binary, digests binary, locators binary, "
          "located binary, counts binary, win_counts binary")


def _lookup(incoming: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """Groups of one shard: every slot with its hits added, then the nonmembers."""
    if not len(index):
        return incoming[["digest", "keep_id", "n", "n_win"]]
    row = index.iloc[0]
    levels, at = [], 0
    for bits in row["level_bits"]:
        size = (int(bits) + 7) // 8
        levels.append(np.unpackbits(np.frombuffer(row["levels"][at:at + size], np.uint8), count=int(bits)).astype(bool))
        at += size
    stored = np.frombuffer(row["digests"], dtype="<u8").reshape(-1, 4)
    size = len(stored)
    ids = np.frombuffer(row["locators"], dtype=np.int64).copy()
    located = np.unpackbits(np.frombuffer(row["located"], np.uint8), count=size).astype(bool)
    counts = np.frombuffer(row["counts"], dtype=np.int64).copy()
    wins = np.frombuffer(row["win_counts"], dtype=np.int64).copy()
    member = np.zeros(len(incoming), dtype=bool)
    if len(incoming):
        keys = _words(incoming["digest"])
        slots = mph_slots(levels, keys)
        member = (slots >= 0) & (stored[slots] == keys).all(axis=1)  # byte check
        s = slots[member]
        hits = incoming[member]
        new_ok = hits["keep_id"].notna().to_numpy()
        new_id = hits["keep_id"].fillna(0).astype("int64").to_numpy()
        new_win = hits["n_win"].astype("int64").to_numpy()
        counts[s] += hits["n"].astype("int64").to_numpy()
        tie = (located[s] == new_ok) & (ids[s] == new_id)
        better = new_ok & (~located[s] | (new_id > ids[s]))
        wins[s] = np.where(tie, wins[s] + new_win, np.where(better, new_win, wins[s]))
        ids[s] = np.where(better, new_id, ids[s])
        located[s] |= new_ok
    old = pd.DataFrame({
        "digest": [stored[i].tobytes() for i in range(size)],
        "keep_id": pd.Series(ids).astype("Int64").where(located, pd.NA),
        "n": counts, "n_win": wins})
    new = incoming.loc[~member, ["digest", "keep_id", "n", "n_win"]].astype({"keep_id": "Int64"})
    return pd.concat([old, new]) if len(new) else old


# -- the operator ------------------------------------------------------------

def _grouped(keyed: DataFrame) -> DataFrame:
    """(digest, keep_id, n, n_win) of the keyed rows; copies combine before the shuffle."""
    per_id = keyed.groupBy("digest", "id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.groupBy("digest").agg(
        F.max("id").alias("keep_id"), F.sum("n").alias("n"),
        F.max(F.struct(F.col("id"), F.col("n"))).getField("n").alias("n_win"))


def digest_groups(history: DataFrame, incoming: DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """Groups of equal digests over both keyed frames ``(id, digest)``."""
    spark = history.sparkSession
    old = written(_grouped(history), "dedup-history")
    new_keys = incoming.agg(F.approx_count_distinct("digest")).first()[0]
    shards = max(1, -(-max(old.count(), new_keys) // shard_keys))
    shard = F.pmod(F.xxhash64("digest"), F.lit(shards)).alias("shard")
    index = (old.select(shard, "digest", "keep_id", "n", "n_win")
             .groupBy("shard").applyInPandas(_index_shard, _INDEX))
    index = written(index, "dedup-index")
    fresh_rows = _grouped(incoming).select(shard, "digest", "keep_id", "n", "n_win")
    return (fresh_rows.groupBy("shard").cogroup(index.groupBy("shard"))
            .applyInPandas(_lookup, _GROUP))


def keyed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), text_digest(F.col(text_col)).alias("digest"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, DataFrame]:
    """(keyed rows, groups) of a whole table. The lower half of the id range is
    the history that earlier loads have indexed, the upper half (and rows
    without an id) the load that comes in."""
    keyed = written(keyed_rows(docs, id_col, text_col), "dedup-keyed")
    lo, hi = keyed.agg(F.min("id"), F.max("id")).first()
    cut = None if lo is None else (lo + hi) // 2
    old = F.coalesce(F.col("id") <= F.lit(cut).cast("long"), F.lit(False))
    groups = digest_groups(keyed.filter(old), keyed.filter(~old), shard_keys)
    return keyed, written(groups, "dedup-groups")


def dedup_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, digest (hex)."""
    keyed, groups = exact_groups(docs, id_col, text_col)
    return keyed.join(groups, "digest").select(
        F.col("id").alias(id_col), "keep_id", F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, same columns."""
    keyed, groups = exact_groups(docs, id_col, text_col)
    dig, lost_id, lost_dig = (fresh(n, docs.columns) for n in ("digest_", "lost_id_", "lost_digest_"))
    lost = (keyed.join(groups, "digest").filter(~F.col("id").eqNullSafe(F.col("keep_id")))
            .select(F.col("id").alias(lost_id), F.col("digest").alias(lost_dig)).distinct())
    rows = docs.withColumn(dig, text_digest(F.col(text_col)))
    kept = rows.join(lost, F.col(id_col).cast("long").eqNullSafe(F.col(lost_id))
                     & (F.col(dig) == F.col(lost_dig)), "left_anti")
    tied = groups.filter("n_win > 1").select(F.col("digest").alias(lost_dig))
    if tied.isEmpty():
        return kept.select(docs.columns)
    same = F.col(dig) == F.col(lost_dig)
    return (kept.join(tied, same, "left_anti")
            .unionByName(kept.join(tied, same, "left_semi").dropDuplicates([dig]))
            .select(docs.columns))
