"""Prefix trie of conversations by truncation peeling.

A conversation becomes a path of turn digests, equal paths become one row that ends there, and paths are range-sorted, so
that a subtree is a run of neighbours. Within a block of the sorted rows, nodes are found from the greatest depth up:
rows that end at a depth join the nodes that survive from below it, the last turn is stripped, and neighbours that now
agree are one node, whose members, children, leaves and tokens are summed as it is found. Only nodes on the first and
last path of a block can go on in another one: what a block knows of them is kept as two open rows. The open rows
of all blocks are peeled again in the same way, with far fewer rows each time, until one block holds them all. So the
number of rounds follows the number of conversations by its logarithm and not the depth of the trie, and a first turn
that many conversations share is summed block by block.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scenetrail.llm.common import query, table
from scenetrail.llm.mix import words
from scenetrail.session import cut

FAMILY = 20  # a conversation borrows from the one whose id is the next lower multiple
BORROWED = 4  # and fewer turns than this
BLOCK_BYTES = 32 << 20  # paths that are peeled at once
LEAST_ROWS = 16  # of a block, however long its paths are, so that each round has an eighth of the rows at most
CHUNK_IDS = 4096  # conversation ids that are handed on as one text
_DIGEST = 16
_NOTHING = hashlib.sha256(b"").hexdigest()
_LAST = np.iinfo(np.int64).max

_KINDS = {"bigint": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary())}
_COUNTS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
_NODE = {**{name: "bigint" for name in _COUNTS}, "ends": "binary", "node": "binary", "parent": "binary"}
_ADDED = ("words", "members", "first", "children", "leaves", "saved")
_OPEN = {"path": "binary", **{name: "array<bigint>" for name in _ADDED}, "ends": "array<binary>"}
_STEP = ", ".join(f"{box} struct<{','.join(f'{n}:{k}' for n, k in kinds.items())}>" for box, kinds in (("found", _NODE), ("open", _OPEN)))


def _struct(kinds: dict[str, str]) -> pa.DataType:
    return pa.struct([(name, _KINDS[kind]) for name, kind in kinds.items()])


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, path (16 bytes a turn), words (of each turn's text), one row for every conversation with an id.

    The turns of the conversation that lends and of those that borrow meet by its id, so one shuffle serves both the
    grouping and the join. Only digests and word counts of the turns are moved, not their texts.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    lender = F.col("conv_id") - F.col("conv_id") % FAMILY
    turn = F.struct(
        "turn",
        F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        words(text).alias("words"),
    )
    own = (
        conversations.filter("conv_id IS NOT NULL")
        .select(F.col("conv_id").cast("bigint").alias("conv_id"), lender.cast("bigint").alias("lender"), turn.alias("turn"))
        .repartition("lender")
        .groupBy("lender", "conv_id")
        .agg(F.sort_array(F.collect_list("turn")).alias("turns"))  # structs sort by turn (null first), then by digest
    )
    lent = own.filter(F.col("conv_id") == F.col("lender")).select("lender", F.slice("turns", 1, BORROWED - 1).alias("lent"))
    n = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(BORROWED)).cast("int")
    turns = F.concat(
        F.slice(F.coalesce("lent", F.expr("filter(turns, t -> false)")), F.lit(1), n),
        F.slice("turns", n + 1, F.greatest(F.size("turns"), F.lit(1))),
    )
    joined = own.join(lent, "lender", "left").select("conv_id", turns.alias("turns"))
    path = F.unhex(F.array_join(F.transform("turns.digest", F.hex), ""))
    return joined.select("conv_id", path.alias("path"), F.col("turns.words").alias("words"))


def _pairs(digests: bytes) -> np.ndarray:
    """16-byte digests as rows of two numbers."""
    return np.frombuffer(digests, np.uint64).reshape(-1, 2)


def ended(convs: DataFrame) -> DataFrame:
    """path, words, members, first, ends: one row a distinct path, with the digest of the ids that end there.

    Ids are sorted in even slices and handed on as texts of some thousand ids, so a path that many conversations
    share is one stream of texts through the hash, and never held.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            node, ids = batch.column(0), batch.column(1).to_numpy()
            raw = _pairs(b"".join(node.to_pylist()))
            new = np.ones(len(ids), bool)
            new[1:] = (raw[1:] != raw[:-1]).any(axis=1)
            starts = np.flatnonzero(new)
            starts = np.unique(np.concatenate([np.arange(a, b, CHUNK_IDS) for a, b in zip(starts, np.append(starts[1:], len(ids)))]))
            ends = np.append(starts[1:], len(ids))
            texts = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays(
                [node.take(pa.array(starts)), pa.array(ids[starts]), pa.array(ends - starts), pa.array(texts, pa.string())], ["node", "first", "n", "ids"]
            )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, first, n = None, None, 0, 0

        def row(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))], ["conv_id", "members", "ends"]
            )

        for batch in batches:
            done = []
            for node, start, count, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if node != current:
                    if state is not None:
                        done.append((first, n, state.digest()))
                    current, state, first, n = node, hashlib.sha256(ids.encode()), start, count
                else:
                    state.update(b"," + ids.encode())
                    n += count
            yield row(done)
        if state is not None:
            yield row([(first, n, state.digest())])

    marked = convs.select(F.unhex(F.md5("path")).alias("node"), "conv_id")
    texts = (
        marked.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
        .mapInArrow(chunks, "node binary, first long, n long, ids string")
    )
    ends = texts.repartition("node").sortWithinPartitions("node", "first").mapInArrow(hashed, "conv_id long, members long, ends binary")
    # The first conversation of a path stands for it; ids are distinct, so this join has no hot key.
    return ends.join(convs, "conv_id").select("path", "words", "members", F.col("conv_id").alias("first"), "ends")


class Block:
    """Sorted paths as flat entries, one for the root and one for each turn, and what each row adds at each of them."""

    def __init__(self, batches: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(batches).combine_chunks()
        paths = rows.column("path").combine_chunks() if rows.num_rows else pa.array([], pa.binary())
        self.paths = paths.to_pylist()
        self.length = np.array([len(p) // _DIGEST for p in self.paths], np.int64)
        self.size = self.length + 1
        self.start = np.concatenate([[0], np.cumsum(self.size)])
        total = int(self.start[-1])
        self.row = np.repeat(np.arange(len(self.paths)), self.size)
        self.depth = np.arange(total) - self.start[self.row]
        self.turns = _pairs(b"".join(self.paths))
        if "leaves" in rows.column_names:  # open rows of an earlier round
            self.at = {f: self._flat(rows, f) for f in _ADDED}
            self.ends = rows.column("ends").combine_chunks().flatten()
        else:
            last = self.start[1:] - 1
            self.at = {f: np.zeros(total, np.int64) for f in _ADDED}
            self.at["words"][self.depth > 0] = self._flat(rows, "words")
            self.at["members"][last] = rows.column("members").to_numpy()
            self.at["first"][:] = _LAST
            self.at["first"][last] = rows.column("first").to_numpy()
            places = np.full(total, -1, np.int64)
            places[last] = np.arange(len(last))
            self.ends = rows.column("ends").combine_chunks().take(pa.array(places, mask=places < 0))
        self.has_end = np.asarray(self.ends.is_valid())

    @staticmethod
    def _flat(rows: pa.Table, name: str) -> np.ndarray:
        return np.array(rows.column(name).combine_chunks().flatten().to_numpy(), np.int64)

    def shared(self) -> np.ndarray:
        """Turns that each row has in common with the one before it; -1 for the first row."""
        out = np.full(len(self.paths), -1, np.int64)
        common = np.minimum(self.length[1:], self.length[:-1])
        if len(out) < 2:
            return out
        begin = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        place = np.concatenate([[0], np.cumsum(common)])
        k = np.arange(place[-1]) - np.repeat(place[:-1], common)
        differs = (self.turns[np.repeat(begin[1:], common) + k] != self.turns[np.repeat(begin[:-1], common) + k]).any(axis=1)
        first = np.append(np.where(differs, k, _LAST), _LAST)
        some = common > 0
        out[1:] = common
        out[1:][some] = np.minimum(common[some], np.minimum.reduceat(first, place[:-1][some]))
        return out


def peeled(block: Block, whole: bool) -> tuple[dict, dict | None]:
    """(nodes of the block, its open rows): no rows stay open if the block is ``whole``.

    Nodes whose parent is open have it given by digest and not by its smallest member.
    """
    n = len(block.paths)
    shared = block.shared()
    by_depth = np.argsort(-block.depth, kind="stable")  # deepest first, rows of a depth in order
    cuts = np.flatnonzero(np.diff(block.depth[by_depth])) + 1
    out: dict[str, list] = {name: [] for name in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "end", "node_at", "parent_at")}
    kept = {f: block.at[f].copy() for f in _ADDED}
    kept_end = np.where(block.has_end, np.arange(len(block.row)), -1)
    below = None  # what the depth below hands on, by row
    waiting = None  # nodes of the depth below, whose parent's smallest member is not known yet
    for entries in np.split(by_depth, cuts):
        rows, depth = block.row[entries], int(block.depth[entries[0]])
        starts = np.flatnonzero((shared[rows] < depth) | (np.arange(len(rows)) == 0))
        lead = rows[starts]
        total = {f: np.add.reduceat(block.at[f][entries], starts) for f in ("members", "children", "leaves", "saved")}
        first = np.minimum.reduceat(block.at["first"][entries], starts)
        end = np.maximum.reduceat(kept_end[entries], starts)
        word = block.at["words"][entries[starts]]
        if below is not None:
            parent = np.searchsorted(lead, below["row"], "right") - 1
            for f in ("members", "children", "leaves", "saved"):
                np.add.at(total[f], parent, below[f])
            np.minimum.at(first, parent, below["first"])
        closed = np.ones(len(lead), bool)
        if not whole:  # the groups of the first and the last row
            last_row = np.append(rows[starts[1:] - 1], rows[-1])
            closed = ~((lead == 0) | (last_row == n - 1))
            # The first row holds the open nodes that it shares with the last one.
            for g in np.flatnonzero(~closed):
                at = block.start[0 if lead[g] == 0 else n - 1] + depth
                for f in ("members", "children", "leaves", "saved"):
                    kept[f][at] = total[f][g]
                kept["first"][at], kept_end[at] = first[g], end[g]
        leaves = np.where(total["children"] == 0, 1, total["leaves"])
        saved = total["saved"] + (total["members"] - 1) * word
        if waiting is not None:
            out["parent_conv_id"].append(np.where(closed[parent[waiting]], first[parent[waiting]], -1))
            out["parent_at"].append(np.where(closed[parent[waiting]], -1, entries[starts[parent[waiting]]]))
        mine = np.flatnonzero(closed)
        for name, values in (
            ("conv_id", first), ("depth", np.full(len(lead), depth)), ("n_convs", total["members"]), ("n_children", total["children"]),
            ("n_leaves", leaves), ("saved_tokens", saved), ("end", end), ("node_at", entries[starts]),
        ):
            out[name].append(values[mine])
        # A closed node goes to its parent whole; an open one stays in its own row.
        below = {"row": lead[mine], "members": total["members"][mine], "children": np.ones(len(mine), np.int64), "leaves": leaves[mine], "saved": saved[mine], "first": first[mine]}
        waiting = np.arange(len(mine))
    out["parent_conv_id"].append(np.full(len(waiting), -1))
    out["parent_at"].append(np.full(len(waiting), -1))
    nodes = {name: np.concatenate(values) for name, values in out.items()}
    if whole:
        return nodes, None
    return nodes, {"rows": [0, n - 1] if n > 1 else [0], "shared": int(shared[1:].min()) if n > 1 else -1, "end": kept_end, **kept}


def _digests(path: bytes) -> list[bytes]:
    """A digest of each prefix of the path, the root's first."""
    state = hashlib.md5(b"")
    out = [state.digest()]
    for at in range(0, len(path), _DIGEST):
        state.update(path[at : at + _DIGEST])
        out.append(state.digest())
    return out


def _blocks(batches: Iterator[pa.RecordBatch], whole: bool, named: bool, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Nodes and open rows of each block of the sorted rows. ``named``: nodes may be the open parents of others."""
    def result(block: Block) -> Iterator[pa.RecordBatch]:
        nodes, left = peeled(block, whole)
        cache: dict[int, list[bytes]] = {}

        def digest(entry: int) -> bytes | None:
            if entry < 0:
                return None
            row = int(block.row[entry])
            if row not in cache:
                cache[row] = _digests(block.paths[row])
            return cache[row][int(block.depth[entry])]

        known = nodes["parent_at"] < 0
        root = nodes["depth"] == 0
        parent_of = {int(e): digest(int(e)) for e in np.unique(nodes["parent_at"])}
        columns = [
            pa.array(nodes["conv_id"]),
            pa.array(nodes["depth"]),
            pa.array(nodes["parent_conv_id"], mask=root | ~known),
            *(pa.array(nodes[f]) for f in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
            block.ends.take(pa.array(nodes["end"], mask=nodes["end"] < 0)).cast(pa.binary()),
            pa.array([digest(int(e)) for e in nodes["node_at"]] if named else [None] * len(root), pa.binary()),
            pa.array([parent_of[int(e)] for e in nodes["parent_at"]], pa.binary()),
        ]
        made = pa.StructArray.from_arrays(columns, list(_NODE))
        for at in range(0, len(made), 10_000):
            part = made.slice(at, 10_000)
            yield pa.RecordBatch.from_arrays([part, pa.nulls(len(part), _struct(_OPEN))], ["found", "open"])
        if left is not None:
            yield open_rows(block, left)

    def open_rows(block: Block, left: dict) -> pa.RecordBatch:
        rows = []
        for k, r in enumerate(left["rows"]):
            a, b = int(block.start[r]), int(block.start[r + 1])
            # What both rows share is in the first one; the second adds nothing there.
            skip = left["shared"] + 1 if k else 0
            row = {"path": block.paths[r], "words": left["words"][a:b].tolist()}
            for f in ("members", "children", "leaves", "saved", "first"):
                row[f] = [_LAST if f == "first" else 0] * skip + left[f][a + skip : b].tolist()
            ends = left["end"][a:b].tolist()
            row["ends"] = [None if d < skip or e < 0 else block.ends[e].as_py() for d, e in enumerate(ends)]
            rows.append(row)
        made = pa.array(rows, _struct(_OPEN))
        return pa.RecordBatch.from_arrays([pa.nulls(len(made), _struct(_NODE)), made], ["found", "open"])

    if whole:
        rows = [batch for batch in batches if batch.num_rows]
        if rows:
            yield from result(Block(rows))
        return
    held, size, count = [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        at = 0
        sizes = np.cumsum([len(p) for p in batch.column("path").to_pylist()]) + np.arange(1, batch.num_rows + 1) * 64
        while at < batch.num_rows:
            done = int(sizes[at - 1]) if at else 0
            to = int(np.searchsorted(sizes, done + block_bytes - size)) + 1
            to = min(batch.num_rows, max(to, at + LEAST_ROWS - count))
            held.append(batch.slice(at, to - at))
            size, count, at = size + int(sizes[to - 1]) - done, count + to - at, to
            if size >= block_bytes and count >= LEAST_ROWS:
                yield from result(Block(held))
                held, size, count = [], 0, 0
    if held:
        yield from result(Block(held))


WHOLE_ROWS, WHOLE_BYTES = 50_000, 64 << 20  # open rows that one task ends with


def trie(conversations: DataFrame, block_bytes: int = BLOCK_BYTES, whole_rows: int = WHOLE_ROWS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: one row a node.

    Null role or text is empty text; a null turn comes first, and equal turn numbers are ordered by the digest of role
    and text, so repeated rows are repeated turns. Rows without conv_id belong to no conversation. Other columns are
    ignored. A conversation that keeps no turn is a member of the root; without conversations there is no root, so an
    empty table gives no rows. A conversation's turns meet as one row of some 30 bytes a turn, its texts do not.
    """
    convs = cut(rebuilt(conversations), "conversations")
    live = cut(ended(convs), "paths")
    found, whole = [], False
    while not whole:
        first = not found
        n, size = live.agg(F.count("*"), F.coalesce(F.sum(F.length("path") * 4 + 64), F.lit(0))).first()
        whole = not first and n <= whole_rows and size <= WHOLE_BYTES
        if first:
            dealt = live.repartitionByRange("path")
        else:  # in rows enough for each task that fewer are left
            dealt = live.repartitionByRange(1 if whole else math.ceil(min(n / 64, max(n / whole_rows, size / WHOLE_BYTES))), "path")
        peel = partial(_blocks, whole=whole, named=not first, block_bytes=block_bytes)
        step = cut(dealt.sortWithinPartitions("path").mapInArrow(peel, _STEP), "nodes")
        found.append(step.filter("found IS NOT NULL").select("found.*"))
        live = step.filter("open IS NOT NULL").select("open.*")
    nodes = reduce(DataFrame.unionByName, found)
    # Children of nodes that were open learn their parent's smallest member; such nodes are two paths a block at most.
    told = reduce(DataFrame.unionByName, found[1:]).select(F.col("node").alias("parent"), F.col("conv_id").alias("told"))
    rest = nodes.filter("parent IS NOT NULL").join(told, "parent").withColumn("parent_conv_id", F.col("told"))
    columns = [*_COUNTS, F.coalesce(F.lower(F.hex("ends")), F.lit(_NOTHING)).alias("ends_sha256")]
    return nodes.filter("parent IS NULL").select(*columns).unionByName(rest.select(*columns))


_STEPS = "[0, 1, 2, 3, 4, 5, 6, 7]"


@query(
    "op11_prefix_trie",
    rf"""
    WITH ids AS (
      SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS lender, CAST(xor(list_reduce(
        list_prepend(4294967295, [ascii(x) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')]),
        LAMBDA c, byte: list_reduce(list_prepend(xor(c, byte), {_STEPS}),
          LAMBDA v, k: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 4 AS INT) AS borrowed
      FROM conversations WHERE conv_id IS NOT NULL
    ), turns AS (
      SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
        md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS i
      FROM conversations WHERE conv_id IS NOT NULL
    ), mine AS (
      SELECT ids.conv_id, t.i, t.role, t.text FROM ids JOIN turns t ON t.conv_id = ids.lender AND t.i <= borrowed
      UNION ALL
      SELECT ids.conv_id, t.i, t.role, t.text FROM ids JOIN turns t ON t.conv_id = ids.conv_id AND t.i > borrowed
    ), numbered AS (
      SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS d, sha256(concat(length(role), ':', role, text)) AS turn,
        len(regexp_extract_all(text, '[^ 	-
]+')) AS words
      FROM mine
    ), paths AS (
      SELECT conv_id, d AS depth, string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY d) AS node, words,
        d = count(*) OVER (PARTITION BY conv_id) AS ended FROM numbered
      UNION ALL
      SELECT conv_id, 0, '', 0, NOT EXISTS (SELECT 1 FROM numbered n WHERE n.conv_id = ids.conv_id) FROM ids
    ), nodes AS (
      SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256
      FROM paths GROUP BY node, depth
    ), children AS (
      SELECT left(node, CAST(64 * (depth - 1) AS INT)) AS node, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
    ), sized AS (
      SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (node, depth)
    ), sums AS (
      SELECT a.node, a.depth, count(*) FILTER (b.n_children = 0) AS n_leaves, CAST(sum((b.n_convs - 1) * b.words) AS BIGINT) AS saved_tokens
      FROM sized a JOIN (SELECT *, unnest(range(depth + 1)) AS above FROM sized) b
        ON a.depth = b.above AND a.node = left(b.node, CAST(64 * b.above AS INT))
      GROUP BY a.node, a.depth
    )
    SELECT s.conv_id, s.depth, p.conv_id AS parent_conv_id, s.n_convs, s.n_children, n_leaves, saved_tokens, s.ends_sha256
    FROM sized s JOIN sums USING (node, depth) LEFT JOIN sized p ON s.depth > 0 AND p.depth = s.depth - 1 AND p.node = left(s.node, CAST(64 * (s.depth - 1) AS INT))
    """,
)
def op11_prefix_trie(spark, sf_dir):
    return trie(table(spark, sf_dir, "conversations"))
