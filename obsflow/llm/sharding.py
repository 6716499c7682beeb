"""Sharding by a permutation-filled lookup table.

The table has a prime number of slots, so every shard's ``offset + i * skip`` walks
through all of them; that walk is the shard's preference order. Shards take
turns, each claiming the first slot on its walk that is still free, until the
table is full. Every shard ends up with an equal number of slots, give or take
one, and when a shard leaves, few slots of the others change hands. A key is
placed by its hash modulo the size: one look into a broadcast table whose size
is a parameter, whatever the data.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

SHARDS = 64
#: Prime, and over a hundred slots for each shard: shares differ by less than one in a hundred.
SLOTS = 8191


def _number(text, salt):
    return int(hashlib.md5(f"{salt}:{text}".encode()).hexdigest()[:15], 16)


def lookup_table(shards, slots=SLOTS):
    """The shard (a position in ``shards``, a list of names) of every slot."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards must be distinct names, at least one")
    if slots < len(shards) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime, at least the number of shards")
    at = [_number(s, "offset") % slots for s in shards]
    skip = [_number(s, "skip") % (slots - 1) + 1 if slots > 2 else 1 for s in shards]
    table, free = [None] * slots, slots
    while free:
        for shard in range(len(shards)):
            while table[at[shard]] is not None:
                at[shard] = (at[shard] + skip[shard]) % slots
            table[at[shard]] = shard
            free -= 1
            if not free:
                break
    return table


def shard_names(n):
    """Names of ``n`` numbered shards."""
    return [f"shard-{i}" for i in range(n)]


def place(df, key="doc_id", shards=SHARDS, slots=SLOTS):
    """``df`` with ``_slot`` and ``_shard``, from the value of column ``key``.

    ``shards`` is a number or a list of names. Equal keys get one shard; a null
    key is placed like an empty text. Other columns stay, and columns named like
    the two new ones are replaced. The only join is with the table, of ``slots``
    rows of two integers, which is broadcast for that reason.
    """
    names = shard_names(shards) if isinstance(shards, int) else list(shards)
    text = ",".join(map(str, lookup_table(names, slots)))
    table = df.sparkSession.range(1).select(F.posexplode(F.split(F.lit(text), ",")).alias("_slot", "_shard"))
    table = table.select(F.col("_slot").cast("long"), F.col("_shard").cast("int"))
    digits = F.substring(F.md5(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary")), 1, 15)
    slot = F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(slots).cast("long"))
    columns = [F.col(f"`{c}`") for c in df.columns if c not in ("_slot", "_shard")]
    return df.select(*columns, slot.alias("_slot")).join(F.broadcast(table), "_slot").select(*columns, "_slot", "_shard")


def place_sql(table, key, shards, slots):
    """The same over a table of DuckDB: the lookup table is spelled out."""
    slots_of = ",".join(map(str, lookup_table(shard_names(shards), slots)))
    return f"""
        WITH placed AS (
            SELECT {key}, ('0x' || substr(md5(coalesce({key}::VARCHAR, '')), 1, 15))::BIGINT % {slots} AS slot FROM {table}
        )
        SELECT {key}, slot, (string_split('{slots_of}', ',')[slot + 1])::INTEGER AS shard FROM placed
    """
