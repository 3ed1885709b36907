"""Prefix trie of conversations: a burst trie whose containers of suffixes are sorted and swept into nodes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.operators.joins import with_parent
from tidemark.operators.ordered import Along, along

TURN = 16  # bytes of a turn's id
BLOCK = 1024  # turns of a conversation that lie in one container; the next ones lie below a head of their own
LIMIT = 8192  # turns a container holds before it bursts, as long as no more than PARTS containers do
PARTS = 1 << 16
MEMBERS = 1 << 16  # conversation ids hashed in one row
OUT = 1 << 14  # nodes of a batch

WORD = r"[^\x20\x09-\x0D]+"
NODE = (
    "box string, parent string, top boolean, shown boolean, depth long, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)
NODE_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
NO_MEMBERS = hashlib.sha256(b"").hexdigest()


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, id, words) of each row of ``conversations`` (conv_id, turn, role, text) that has a conv_id.

    ``pos`` counts from 1 by turn, null first; turns that are given twice are ordered by ``id``, a digest
    of role and text. A conversation that holds most rows is cut into slices of its turns.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("id"),
        F.regexp_count(text, F.lit(WORD)).alias("words"),
    )
    return along(rows, ["conv_id"], ["turn", "id"], Along(number="pos")).drop("turn")


def rebuilt(conversations: DataFrame, donor_every: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of a donor: (conv_id, at, id, words) and (conv_id, length).

    The first h = crc32(conv_id) % ``heads`` turns of c become the first h of conversation
    c - c % ``donor_every``, as many as it has. ``at`` counts the turns from 0. Every conv_id has a
    length, 0 where nothing is left.
    """
    turns = stored(numbered_turns(conversations), "trie-turns")
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n_own"))
    own = own.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads)
    own = own.withColumn("donor", F.col("conv_id") - F.col("conv_id") % donor_every)
    leading = turns.where((F.col("pos") < heads) & (F.col("conv_id") % donor_every == 0)).withColumnRenamed("conv_id", "donor")
    given = leading.groupBy("donor").agg(F.count("*").alias("n_donor"))
    taken = F.least("h", F.coalesce("n_donor", F.lit(0)))
    plan = stored(own.join(given, "donor", "left").withColumn("taken", taken).drop("n_donor"), "trie-plan")
    first = plan.join(leading, "donor").where("pos <= h").select("conv_id", (F.col("pos") - 1).alias("at"), "id", "words")
    rest = with_parent(turns, plan.select("conv_id", "h", "taken"), ["conv_id"]).where("pos > h")
    rest = rest.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken") - 1).alias("at"), "id", "words")
    length = F.col("taken") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))
    return first.unionByName(rest), plan.select("conv_id", length.alias("length"))


def block_rows(turns: DataFrame, lengths: DataFrame, block: int) -> DataFrame:
    """(conv_id, level, head, next_head, path, words, last): stretches of ``block`` turns of each conversation.

    ``path`` joins the turns' ids; ``head`` and ``next_head`` name all that precedes the stretch and that
    with the stretch. A conversation without turns has one empty stretch.
    """
    one = F.struct("at", "id", "words")
    rows = turns.groupBy("conv_id", F.floor(F.col("at") / block).alias("level")).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    rows = rows.select(
        "conv_id",
        "level",
        F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), "")).alias("path"),
        F.transform("turns", lambda t: t["words"]).alias("words"),
    )
    empty = lengths.where("length = 0").select("conv_id", F.lit(0).cast("long").alias("level"), F.lit(b"").alias("path"), F.array().cast("array<int>").alias("words"))
    rows = rows.unionByName(empty)
    order = Window.partitionBy("conv_id").orderBy("level")
    digest = F.md5("path")
    halves = [F.xxhash64(digest, "level"), F.xxhash64("level", digest)]  # a set of them names a sequence

    def name(level: Column, window: Window) -> Column:
        return F.concat_ws("-", level.cast("string"), *[F.coalesce(F.bit_xor(h).over(window), F.lit(0)).cast("string") for h in halves])

    before, until = (order.rowsBetween(Window.unboundedPreceding, end) for end in (-1, Window.currentRow))
    return rows.select(
        "*",
        name(F.col("level"), before).alias("head"),
        name(F.col("level") + 1, until).alias("next_head"),
        F.lead("level").over(order).isNull().alias("last"),
    ).withColumn("key", F.md5(F.concat(F.col("head").cast("binary"), F.col("path"))))


def member_digests(members: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 of the conv_ids of each key in ascending order, joined by commas.

    Ids are sorted and written down by range, so that a key of most conversations is dealt over many
    tasks; what one task hashes in order are rows of up to MEMBERS ids, which it does not hold.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = (c.to_pylist() for c in batch.columns)
            for key, some in groupby(range(len(keys)), keys.__getitem__):
                some = list(some)
                for at in range(0, len(some), MEMBERS):
                    part = [ids[i] for i in some[at : at + MEMBERS]]
                    yield pa.RecordBatch.from_pydict({"key": [key], "least": [part[0]], "ids": [",".join(map(str, part))]})

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = chain.from_iterable(zip(*[c.to_pylist() for c in batch.columns], strict=True) for batch in batches)
        keys, found = [], []
        for key, parts in groupby(rows, lambda r: r[0]):
            state = hashlib.sha256()
            for n, (_, _, ids) in enumerate(parts):
                state.update(("," * bool(n) + ids).encode())
            keys.append(key)
            found.append(state.hexdigest())
            if len(keys) == OUT:
                yield pa.RecordBatch.from_pydict({"key": keys, "ends_sha256": found})
                keys, found = [], []
        if keys:
            yield pa.RecordBatch.from_pydict({"key": keys, "ends_sha256": found})

    order = members.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").select("key", "conv_id")
    parts = order.mapInArrow(write, "key string, least long, ids string")
    return parts.repartition("key").sortWithinPartitions("key", "least").mapInArrow(digest, "key string, ends_sha256 string")


def shared_turns(a: bytes, b: bytes, at: int) -> int:
    """How many turns two paths begin with alike, ``at`` of which are known."""
    until = min(len(a), len(b)) // TURN
    while at < until and a[TURN * at : TURN * (at + 1)] == b[TURN * at : TURN * (at + 1)]:
        at += 1
    return at


def sweep(rows: list[dict]) -> list[tuple]:
    """The nodes of one container from its suffixes in order of ``path``, as tuples of NODE without box and parent.

    Each suffix opens the nodes it does not share with the one before it; sums run from the last node
    opened to the first, parents after their children.
    """
    top = rows[0]
    k = top["k"]
    depth, up, n, conv, kids, leaves, saved, ends = [k], [-1], [0], [None], [0], [0], [0], [NO_MEMBERS]
    words = [top["words"][k - 1] if k else 0]
    stack, before = [0], top["path"]
    for row in rows:
        path, size = row["path"], len(row["path"]) // TURN
        same = min(shared_turns(before, path, k), k + len(stack) - 1)
        del stack[same - k + 1 :]
        for d in range(same, size):
            depth.append(d + 1)
            up.append(stack[-1])
            words.append(row["words"][d])
            stack.append(len(n))
            for values, zero in ((n, 0), (conv, None), (kids, 0), (leaves, 0), (saved, 0), (ends, NO_MEMBERS)):
                values.append(zero)
        i = stack[-1]
        n[i], conv[i], ends[i] = row["n"], row["conv"], row["ends_sha256"] or NO_MEMBERS
        kids[i], leaves[i], saved[i] = row["below_children"] or 0, row["below_leaves"] or 0, row["below_saved"] or 0
        before = path
    for i in range(len(n) - 1, -1, -1):
        leaves[i] = leaves[i] if kids[i] else 1
        saved[i] += (n[i] - 1) * words[i]
        if i:
            p = up[i]
            n[p] += n[i]
            conv[p] = conv[i] if conv[p] is None else min(conv[p], conv[i])
            kids[p] += 1
            leaves[p] += leaves[i]
            saved[p] += saved[i]
    hidden = not k and top["base"]  # the node above a later block belongs to the container before it
    if hidden:
        conv[0] = top["parent_conv"]
    parents = [top["parent_conv"], *[conv[p] for p in up[1:]]]
    return [
        (not i, bool(i or not hidden), top["base"] + depth[i], conv[i], parents[i], n[i], kids[i], leaves[i], saved[i], ends[i])
        for i in range(len(n))
    ]


def swept(containers: DataFrame) -> DataFrame:
    """NODE rows of all containers: shards of whole ones, sorted by Spark, one at a time in memory."""
    names = [f.split()[0] for f in NODE.split(", ")]
    kinds = [pa.string(), pa.string(), pa.bool_(), pa.bool_(), *[pa.int64()] * 7, pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = chain.from_iterable(batch.to_pylist() for batch in batches)
        nodes: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = zip(*nodes, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

        for box, some in groupby(rows, lambda r: r["box"]):
            some = list(some)
            nodes += [(box, some[0]["parent"], *node) for node in sweep(some)]
            if len(nodes) >= OUT:
                yield batch()
                nodes.clear()
        if nodes:
            yield batch()

    return containers.repartition("box").sortWithinPartitions("box", "path").mapInArrow(run, NODE)


def heads_of(open_: DataFrame, limit: int) -> DataFrame:
    """Containers of more than ``limit`` turns: (box, parent, k, base, parent_conv, n, conv, words, shared).

    ``shared`` is the depth down to which all of a container's suffixes agree. There are at most PARTS
    of them, so they may be broadcast.
    """
    large = open_.groupBy("box").agg(F.sum("size").alias("turns")).where(F.col("turns") > limit).select("box")
    same = [F.first(c).alias(c) for c in ("parent", "k", "base", "parent_conv")]
    least, most = F.min(F.struct("path", "words")).alias("least"), F.max("path").alias("most")
    heads = open_.join(F.broadcast(large), "box").groupBy("box").agg(*same, F.sum("n").alias("n"), F.min("conv").alias("conv"), least, most)
    until = F.floor(F.least(F.octet_length("least.path"), F.octet_length("most")) / TURN).cast("int")

    def turn(path: str, i: Column) -> Column:
        return F.substring(F.col(path), (i - 1) * TURN + 1, F.lit(TURN))

    alike = F.transform(F.sequence(F.lit(1), F.greatest(until, F.lit(1))), lambda i: (i <= until) & (turn("least.path", i) == turn("most", i)))
    differs = F.array_position(alike, False)
    return heads.select(
        "box", "parent", "k", "base", "parent_conv", "n", "conv",
        F.col("least.words").alias("words"),
        F.when(differs == 0, until).otherwise(differs - 1).cast("int").alias("shared"),
    )


def burst(items: DataFrame, limit: int) -> tuple[list[DataFrame], list[tuple[DataFrame, DataFrame]]]:
    """Containers of at most ``limit`` turns, and the heads of each round with what ends at them.

    All suffixes of a head share its turns. A container above the limit becomes a head, at the depth
    down to which its suffixes agree, and each next turn a container of its own; so every round divides
    what it bursts. Conversations that end at the head leave only their digest.
    """
    no_parent = F.lit(None).cast("string").alias("parent")
    open_ = items.select("*", F.col("head").alias("box"), no_parent, F.lit(0).alias("k"))
    closed, rounds = [], []
    while True:
        heads = stored(heads_of(open_, limit), "trie-heads")
        if heads.isEmpty():
            return [*closed, open_], rounds
        is_hidden = (F.col("base") > 0) & (F.col("shared") == 0)
        tags = heads.select("box", "shared", F.when(is_hidden, F.col("parent_conv")).otherwise(F.col("conv")).alias("above"))
        tagged = stored(open_.join(F.broadcast(tags), "box", "left"), "trie-open")
        closed.append(tagged.where("shared is null").drop("shared", "above"))
        ending = F.octet_length("path") == F.col("shared") * TURN
        rounds.append((heads, tagged.where("shared is not null").where(ending).select("box", "ends_sha256")))
        more = tagged.where("shared is not null").where(~ending)
        step = F.substring(F.col("path"), F.col("k") * TURN + 1, (F.col("shared") + 1 - F.col("k")) * TURN)
        open_ = more.withColumns({
            "parent": F.col("box"),
            "box": F.md5(F.concat(F.col("box").cast("binary"), step)),
            "k": F.col("shared") + 1,
            "parent_conv": F.col("above"),
        }).drop("shared", "above")


def head_nodes(heads: DataFrame, ends: DataFrame, below: DataFrame) -> DataFrame:
    """NODE rows of the heads of one round, one for each depth they pass, from the tops of what hangs below them."""
    sums = below.groupBy(F.col("parent").alias("box")).agg(
        F.count("*").alias("children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved")
    )
    rows = heads.join(sums, "box").join(ends, "box", "left").withColumn("at", F.explode(F.sequence("k", "shared")))
    is_last, is_top = F.col("at") == F.col("shared"), F.col("at") == F.col("k")
    is_first = is_top | (F.col("base") > 0) & (F.col("at") == 1)  # its parent is no node of this container
    start = F.greatest("at", F.lit(1))
    spoken = F.aggregate(F.slice("words", start, F.greatest(F.col("shared") - start + 1, F.lit(0))), F.lit(0).cast("long"), lambda s, w: s + w)
    return rows.select(
        "box", "parent",
        is_top.alias("top"),
        ((F.col("at") > 0) | (F.col("base") == 0)).alias("shown"),
        (F.col("base") + F.col("at")).alias("depth"),
        F.col("conv").alias("conv_id"),
        F.when(is_first, F.col("parent_conv")).otherwise(F.col("conv")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(is_last, F.col("children")).otherwise(1).alias("n_children"),
        "n_leaves",
        (F.col("saved") + (F.col("n") - 1) * spoken).alias("saved_tokens"),
        F.when(is_last, F.coalesce("ends_sha256", F.lit(NO_MEMBERS))).otherwise(NO_MEMBERS).alias("ends_sha256"),
    )


def level_nodes(items: DataFrame, limit: int) -> DataFrame:
    """NODE rows of one block of all conversations; of its heads the tops without a parent sum up what is below."""
    closed, rounds = burst(items, limit)
    containers = closed[0]
    for some in closed[1:]:
        containers = containers.unionByName(some)
    leaves = stored(swept(containers), "trie-nodes")
    nodes, below = leaves, leaves.where("top")
    for heads, ends in reversed(rounds):
        spine = stored(head_nodes(heads, ends, below), "trie-spine")
        nodes, below = nodes.unionByName(spine), below.unionByName(spine.where("top"))
    return nodes


def prefix_trie(turns: DataFrame, lengths: DataFrame, block: int = BLOCK, limit: int = LIMIT) -> DataFrame:
    """One row (NODE_COLUMNS) per distinct sequence of first d turns of the conversations, the root with d = 0.

    ``turns`` has (conv_id, at, id, words): hexadecimal digests of 16 bytes and word counts, ``at`` from
    0 without gaps; ``lengths`` has (conv_id, length) of every conversation, those without turns too.
    ``conv_id`` is a node's smallest member; ``saved_tokens`` sums (members - 1) times the last turn's
    words over its subtree; ``ends_sha256`` digests the members that end there.

    Equal stretches are merged before anything is sorted, so copies cost one row; a container that
    exceeds ``limit`` turns bursts by next turn, and a conversation of more than ``block`` turns goes on
    in a container below a head of its own. Memory of a task is bounded by a container: ``limit`` turns,
    or a 65,536th of all distinct ones. An empty table gives no rows.
    """
    blocks = stored(block_rows(turns, lengths, block), "trie-blocks")
    same = [F.first(c).alias(c) for c in ("level", "head", "next_head", "path", "words")]
    items = blocks.groupBy("key").agg(*same, F.count("*").alias("n"), F.min("conv_id").alias("conv"))
    ends = member_digests(blocks.where("last").select("key", "conv_id"))
    size = (F.octet_length("path") / TURN).cast("long") + 1
    items = stored(items.join(ends, "key", "left").withColumn("size", size), "trie-items")
    total, deepest = items.agg(F.sum("size"), F.max("level")).first()
    nodes, below = None, None
    for level in range(-1 if deepest is None else deepest, -1, -1):
        some = items.where(F.col("level") == level).withColumn("base", F.lit(level * block).cast("long"))
        above = items.where(F.col("level") == level - 1).select(F.col("next_head").alias("head"), F.col("conv").alias("parent_conv"))
        some = with_parent(some, above, ["head"], "left") if level else some.withColumn("parent_conv", F.lit(None).cast("long"))
        sums = ["below_children", "below_leaves", "below_saved"]
        if below is None:
            some = some.withColumns({c: F.lit(None).cast("long") for c in sums})
        else:
            some = some.join(below, "next_head", "left")
        found = level_nodes(some.drop("level", "next_head", "key"), max(limit, total // PARTS))
        roots = found.where("top and parent is null")
        below = roots.select(F.col("box").alias("next_head"), *[F.col(c).alias(s) for c, s in zip(("n_children", "n_leaves", "saved_tokens"), sums, strict=True)])
        shown = found.where("shown").select(*NODE_COLUMNS)
        nodes = shown if nodes is None else nodes.unionByName(shown)
    if nodes is None:
        return turns.sparkSession.createDataFrame([], ", ".join(f.strip() for f in NODE.split(",")[4:])).select(*NODE_COLUMNS)
    return nodes
