"""Merkle manifest of a table as a persistent path-copying tree (operator 11).

Every row is a leaf: the digest of its fields, each written as its byte count and value or
as ``-`` if null. The leaves of a group (``source``) stand in order of their id, and every
``ARITY`` consecutive nodes of a level become one node above, until one is left, the
group's subroot. The subroots, in byte order of the group with null first, make a tree in
the same way; its top is the root.

The tree is built in aligned blocks of ``ARITY ** LEVELS`` nodes: a task holds one block,
hands its top to the next round of blocks, and rounds go on until every group has one node,
so their number grows with the logarithm of the rows. A changed leaf makes a new version of
the tree: within its block it copies only the ancestors of that leaf and shares every other
node, and the top it leaves goes on as a row of its own to the block above, where it copies
the path there. Versions of one upper block are dealt to parts, each with a copy of the
block's nodes, so that a group with a third of all rows doesn't meet in one task. Proofs go
the other way: each block is handed the siblings above it and passes them on, with its own,
to its members.

Rows of a group with one id stand in order of their digests; null ids come first. Any id or
group type works whose values Spark can order; ids and groups are compared as they are and
digested as text. Null fields count as ``-``, so null and empty texts differ. A table of one row has that leaf
as its subroot and root, and a proof of nothing. An empty table gives no rows. Extra
columns are ignored. Long texts are digested by Spark and never reach Python.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.skew import salted_left_join
from ..session import settle
from .common import ddl, map_batches

ARITY = 16
LEVELS = 3
BLOCK = ARITY**LEVELS
DIGEST = 64
RUN = ARITY * DIGEST
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
VERSIONS_PER_PART = 65_536


def digest(data: bytes) -> bytes:
    return sha256(data).hexdigest().encode()


class Block:
    """The nodes over one aligned run of digests, a level as the digests' hex text in a row."""

    def __init__(self, leaves: bytes, height: int):
        self.levels = [leaves]
        for _ in range(height):
            below = self.levels[-1]
            self.levels.append(b"".join(digest(below[i : i + RUN]) for i in range(0, len(below), RUN)))

    @property
    def top(self) -> bytes:
        return self.levels[-1]

    def siblings(self, at: int) -> bytes:
        """The rest of the runs on the way up from a leaf, level by level."""
        found = []
        for level in self.levels[:-1]:
            run, own = at // ARITY * RUN, at * DIGEST
            found += (level[run:own], level[own + DIGEST : run + RUN])
            at //= ARITY
        return b"".join(found)

    def version(self, at: int, leaf: bytes) -> list[bytes]:
        """The nodes that a changed leaf copies: its own and its ancestors, the top last.

        All other nodes are shared with this block, which stays as it is.
        """
        copies = [leaf]
        for level in self.levels[:-1]:
            run, own = at // ARITY * RUN, at * DIGEST
            copies.append(digest(level[run:own] + copies[-1] + level[own + DIGEST : run + RUN]))
            at //= ARITY
        return copies


def height(nodes: int) -> int:
    """Levels a block adds: all of them in a group of several blocks, else up to one node."""
    levels = 0
    while levels < LEVELS and ARITY**levels < nodes:
        levels += 1
    return levels


def field(c: Column) -> Column:
    text = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*fields: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in fields]), 256))


def lowered(text: Column) -> Column:
    """Only the letters A-Z in lower case."""
    capitals = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    return F.translate(text, capitals, capitals.lower())


def by_groups(batches, keys: list[str]):
    """(key, table) of rows that stand together, across the borders of batches; no null keys."""
    mark, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows - 1, bool)
        for k in keys:
            column = batch.column(k)
            new |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False).astype(bool)
        edges = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            key = tuple(batch.column(k)[a].as_py() for k in keys)
            if key != mark and held:
                yield mark, pa.Table.from_batches(held)
                held = []
            mark = key
            held.append(batch.slice(a, b - a))
    if held:
        yield mark, pa.Table.from_batches(held)


def numbered(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` with ``at``, the place of a row in its group, and ``n``, the group's rows.

    Rows are dealt to ranges and sorted there, so that no task needs a whole group; the
    places of the ranges before come from one count per range and group.
    """
    columns = df.columns

    def place(batches):
        part, last, reached = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            codes = batch.column(group).dictionary_encode()
            index = codes.indices.to_numpy(zero_copy_only=False)
            if not len(index):
                continue
            begins = np.concatenate([[0], np.flatnonzero(np.diff(index)) + 1])
            own = np.arange(len(index)) - np.repeat(begins, np.diff(np.append(begins, len(index))))
            values = codes.dictionary
            if values[int(index[0])].as_py() == last:
                own[: begins[1] if len(begins) > 1 else None] += reached
            last, reached = values[int(index[-1])].as_py(), int(own[-1]) + 1
            yield {c: batch.column(c) for c in columns} | {"part": np.full(len(own), part), "own": own}

    dealt = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    rows = settle(map_batches(dealt, f"{ddl(df)}, part int, own long", place), name)
    counts = rows.groupBy(group, "part").agg(F.count(F.lit(1)).alias("c"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        group, "part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("before"), F.sum("c").over(whole).alias("n")
    )
    return rows.join(counts, [group, "part"]).select(*columns, (F.col("own") + F.col("before")).alias("at"), "n")


def _in_blocks(nodes: DataFrame, *more: str) -> DataFrame:
    dealt = nodes.withColumn("block", F.floor(F.col("at") / BLOCK).cast("long"))
    return dealt.repartition("grp", "block", *more).sortWithinPartitions("grp", "block", *more, *(["kind"] if "kind" in nodes.columns else []), "at")


def _text(column) -> bytes:
    return b"".join(column.to_pylist()).hex().encode()


TOPS = "grp string, n long, at long, digest binary, of_grp string, of_at long, copies array<binary>"


def _columns(rows: list[tuple]) -> dict:
    names = ("grp", "n", "at", "digest", "of_grp", "of_at", "copies")
    return {n: [r[i] for r in rows] for i, n in enumerate(names)}


def _version(block: Block, grp: str, n: int, number: int, at: int, leaf: bytes, of: tuple) -> tuple:
    copies = [bytes.fromhex(c.decode()) for c in block.version(at, leaf.hex().encode())]
    return grp, n, number, copies[-1], *of, copies


def _build(batches):
    """Block tops, and beside them the tops of the versions that changed leaves make."""
    out: list[tuple] = []
    for (grp, number), held in by_groups(batches, ["grp", "block"]):
        n = held.column("n")[0].as_py()
        block = Block(_text(held.column("digest")), height(n))
        above = -(-n // BLOCK)
        out.append((grp, above, number, bytes.fromhex(block.top.decode()), None, None, None))
        if "changed" in held.column_names:
            for i, changed in enumerate(held.column("changed").to_pylist()):
                if changed is not None:
                    out.append(_version(block, grp, above, number, i, changed, (grp, number * BLOCK + i)))
        if len(out) > 20_000:
            yield _columns(out)
            out = []
    yield _columns(out)


def _rebuild(batches):
    """Versions one round further up: each part holds its block's nodes, then the versions."""
    out: list[tuple] = []
    for (grp, number, _), held in by_groups(batches, ["grp", "block", "part"]):
        base = held.filter(pc.equal(held.column("kind"), 0))
        changed = held.filter(pc.equal(held.column("kind"), 1))
        n = held.column("n")[0].as_py()
        block = Block(_text(base.column("digest")), height(n))
        for row in changed.select(["at", "digest", "of_grp", "of_at"]).to_pylist():
            of = (row["of_grp"], row["of_at"])
            out.append(_version(block, grp, -(-n // BLOCK), number, row["at"] - number * BLOCK, row["digest"], of))
        if len(out) > 20_000:
            yield _columns(out)
            out = []
    yield _columns(out)


@dataclass
class Climbed:
    """Rounds of blocks, lowest first: the nodes that went in, and the versions so far."""

    rounds: list[DataFrame]
    tops: DataFrame
    versions: DataFrame
    copied: list[DataFrame]


def _climb(nodes: DataFrame, versions: DataFrame | None, part: Column) -> Climbed:
    """Build blocks over ``nodes`` until every group has one node left.

    ``nodes`` may have a column ``changed`` (lowest round), else ``versions`` are the rows
    that enter; ``part`` deals those of a block to parts.
    """
    rounds, copied = [], []
    while True:
        most = nodes.agg(F.max("n")).head()[0] or 0
        if most <= 1 and "changed" not in nodes.columns:
            return Climbed(rounds, nodes, versions, copied)
        rounds.append(nodes)
        built = settle(map_batches(_in_blocks(nodes), TOPS, _build), "merkle-tops")
        if versions is None:
            moved = built.where("copies is not null")
        else:
            entered = versions.drop("copies").withColumn("part", part).withColumn("block", F.floor(F.col("at") / BLOCK).cast("long"))
            parts = entered.select("grp", "block", "part").distinct()
            base = nodes.select("grp", "n", "at", "digest", F.floor(F.col("at") / BLOCK).cast("long").alias("block"))
            base = base.join(parts, ["grp", "block"]).withColumns(
                {"kind": F.lit(0), "of_grp": F.lit(None).cast("string"), "of_at": F.lit(None).cast("long")}
            )
            both = base.unionByName(entered.withColumn("kind", F.lit(1))).drop("block")
            moved = settle(map_batches(_in_blocks(both, "part"), TOPS, _rebuild), "merkle-versions")
        copied.append(moved)
        nodes = built.where("copies is null").select("grp", "n", "at", "digest")
        versions = moved.select("grp", "n", "at", "digest", "of_grp", "of_at", "copies")


def _descend(nodes: DataFrame, headers: DataFrame, schema: str, task) -> DataFrame:
    """Hand each block its header (grp, at, above, ...) and run ``task`` on its members."""
    extra = [c for c in headers.columns if c not in ("grp", "at")]
    top = headers.select("grp", F.col("at").alias("block"), F.lit(0).alias("kind"), *extra)
    rows = nodes.withColumn("block", F.floor(F.col("at") / BLOCK).cast("long")).withColumn("kind", F.lit(1))
    both = top.unionByName(rows, allowMissingColumns=True)
    met = both.repartition("grp", "block").sortWithinPartitions("grp", "block", "kind", "at")
    return map_batches(met, schema, lambda batches: (task(key, held) for key, held in by_groups(batches, ["grp", "block"])))


def _members(held) -> tuple[pa.Table, Block, dict]:
    header, own = held.slice(0, 1).to_pylist()[0], held.slice(1)
    return own, Block(_text(own.column("digest")), height(own.column("n")[0].as_py())), header


def _pass_on(key, held) -> dict:
    own, block, header = _members(held)
    above = header["above"]
    return {
        "grp": own.column("grp"),
        "at": own.column("at"),
        "above": [block.siblings(i).decode() + above for i in range(own.num_rows)],
        "subroot": [header["subroot"] if "subroot" in header else None] * own.num_rows,
    }


def _prove(key, held) -> dict:
    own, block, header = _members(held)
    above = header["above"].encode()
    return {c: own.column(c) for c in ("id", "grp", "at", "digest")} | {
        "subroot": [header["subroot"]] * own.num_rows,
        "proof_sha256": [digest(block.siblings(i) + above).decode() for i in range(own.num_rows)],
    }


ABOVE = "grp string, at long, above string, subroot string"


@dataclass
class Manifest:
    """``leaves`` (id, leaf, subroot, proof_sha256, folded_root), the ``root`` (null for an
    empty table), and ``copies``: the nodes every changed leaf copied, as
    (id_group, id_at, round, level, digest), the lowest first."""

    leaves: DataFrame
    root: str | None
    copies: DataFrame


def manifest(rows: DataFrame) -> Manifest:
    """The tree over ``rows`` (id, grp_value, digest binary, changed binary or null).

    ``changed`` is the digest of the tampered row: such a leaf is one version of the tree,
    whose root is ``folded_root``; all others have the tree's own root there.
    """
    spark = rows.sparkSession
    # The group as text that orders as the group does, null first, and is never null.
    grp = F.when(F.col("grp_value").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("grp_value").cast("string")))
    flat = settle(rows.select("id", grp.alias("grp"), "digest", "changed"), "merkle-leaves")
    placed = settle(numbered(flat, "grp", ["id", "digest"], "merkle-places"), "merkle-numbered")
    leaves = placed.select("grp", "n", "at", "digest", "changed")
    low = _climb(leaves, None, F.floor(F.col("of_at") / VERSIONS_PER_PART).cast("long"))
    subroots = low.tops.select("grp", F.col("digest"))
    ranked = settle(
        numbered(subroots.select(F.lit("").alias("all"), "grp", "digest"), "all", ["grp"], "merkle-sources"), "merkle-ranks"
    )
    ranks = ranked.select("grp", F.col("at").alias("rank"), F.col("n").alias("sources"))
    entered = salted_left_join(low.versions.select("grp", "digest", "of_grp", "of_at"), ranks, "grp", "of_at")
    entered = settle(
        entered.select(
            F.lit("").alias("grp"), F.col("sources").alias("n"), F.col("rank").alias("at"), "digest", "of_grp", "of_at",
            F.lit(None).cast("array<binary>").alias("copies"),
        ),
        "merkle-entered",
    )
    parts = max(1, -(-entered.count() // VERSIONS_PER_PART))
    upper = _climb(
        ranked.select(F.lit("").alias("grp"), "n", "at", "digest"), entered, F.pmod(F.xxhash64("of_grp", "of_at"), F.lit(parts))
    )
    top = upper.tops.select(F.lower(F.hex("digest"))).head()
    root = top[0] if top else None

    none = F.lit(None).cast("string")
    above = spark.createDataFrame([("", 0, "", None)], ABOVE)
    for nodes in reversed(upper.rounds):
        above = _descend(nodes, above.select("grp", "at", "above"), ABOVE, _pass_on)
    above = ranked.join(above.select(F.col("at").alias("rank"), "above"), F.col("at") == F.col("rank")).select(
        "grp", F.lit(0).cast("long").alias("at"), "above", F.lower(F.hex("digest")).alias("subroot")
    )
    for nodes in reversed(low.rounds[1:]):
        above = _descend(nodes, above, ABOVE, _pass_on)
    kind = placed.schema["id"].dataType.simpleString()
    proved = _descend(
        placed.drop("changed"),
        above,
        f"id {kind}, grp string, at long, digest binary, subroot string, proof_sha256 string",
        _prove,
    )
    folded = upper.versions.select(F.col("of_grp").alias("grp"), F.col("of_at").alias("at"), F.lower(F.hex("digest")).alias("folded"))
    met = proved.join(folded, ["grp", "at"], "left")
    tree_root = F.lit(root) if root is not None else none
    out = met.select(
        "id", F.lower(F.hex("digest")).alias("leaf"), "subroot", tree_root.alias("root"), "proof_sha256",
        F.coalesce("folded", tree_root).alias("folded_root"),
    )
    copies = None
    for number, moved in enumerate([*low.copied, *upper.copied]):
        own = moved.select(
            F.col("of_grp").alias("id_group"), F.col("of_at").alias("id_at"), F.lit(number).alias("round"),
            F.posexplode("copies").alias("level", "digest"),
        )
        copies = own if copies is None else copies.unionByName(own)
    return Manifest(out, root, copies)


def tampered_manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", text_col: str = "text", fields: tuple[str, ...] = FIELDS, one_in: int = 5) -> Manifest:
    """The manifest of ``docs`` with a tampered version per row whose id's crc32 ``one_in``
    divides: its text with A-Z in lower case. A null id is never tampered with."""
    named = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{group_col}`").alias("grp_value"), F.col(f"`{text_col}`").alias("__t"), *[F.col(f"`{c}`").alias(f"__f{i}") for i, c in enumerate(fields)])
    own = [F.col(f"__f{i}") for i in range(len(fields))]
    other = [lowered(F.col("__t")) if c == text_col else x for c, x in zip(fields, own)]
    hit = F.crc32(F.col("id").cast("string").cast("binary")) % one_in == 0
    return manifest(
        named.select("id", "grp_value", leaf_digest(*own).alias("digest"), F.when(hit, leaf_digest(*other)).alias("changed"))
    )
