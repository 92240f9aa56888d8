"""Near duplicates by MinHash and an LSH forest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewell.functions.session import settle
from tidewell.llm.common import by_bytes, shuffle_partitions, stored
from tidewell.llm.components import components

# A signature has one byte per hash function. Each of the ORDERS sorted orders
# starts ORDER_STEP bytes further on, so their first ORDER_STEP bytes differ.
HASHES, ORDERS = 96, 12
ORDER_STEP = HASHES // ORDERS
# Bytes that neighbours must share at least, and how many rows after a row are
# its neighbours where more share them: the order puts those with the longest
# common prefix next to it.
LEAST_DEPTH, REACH = 4, 32
# A pair is a candidate unless its signatures agree in so few places that the
# threshold is this many standard deviations away.
SLACK = 4.5
# Shingles of a block of rows that are compared with another block, about, and
# hashes of the sketches they are compared by.
BLOCK, SKETCH_HASHES = 1 << 18, 512


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles; a shorter text is one shingle as a whole."""
    import xxhash

    # bytes.lower and bytes.split know ASCII letters and ASCII white space only
    spoken = (text or "").encode().lower().split()
    if not spoken:
        return np.zeros(0, np.uint64)
    hashed = np.array([xxhash.xxh3_64_intdigest(word) for word in spoken], np.uint64)
    width = min(words, len(hashed))
    combined = np.full(len(hashed) - width + 1, width, np.uint64)
    for k in range(width):
        combined = _mix(combined + hashed[k:len(hashed) - width + 1 + k])
    return np.unique(combined)


def signature(shingles: np.ndarray) -> bytes:
    """One byte of the smallest hash of the set under each hash function."""
    random = np.random.default_rng(5)
    flip = random.integers(0, 1 << 63, HASHES, np.uint64)
    times = random.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(HASHES, ~np.uint64(0))
    for at in range(0, len(shingles), 1024):
        least = np.minimum(least, ((shingles[at:at + 1024, None] ^ flip) * times).min(axis=0))
    return ((least >> np.uint64(8)) & np.uint64(255)).astype(np.uint8).tobytes()


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, n_shingles, _d1, _d2, _sig`` of every document; equal sets have equal ``_d1, _d2``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in by_bytes(batches):
            n, digests, signed = [], [], []
            for text in batch.column("text").to_pylist():
                own = shingle_set(text, words)
                n.append(len(own))
                digests.append(xxhash.xxh3_128_digest(own.tobytes()))
                signed.append(signature(own) if len(own) else None)
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), pa.array(signed, pa.binary())],
                names=["doc_id", "n_shingles", "_d1", "_d2", "_sig"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_shingles long, _d1 long, _d2 long, _sig binary")


def _near(rows: pa.RecordBatch | pa.Table, first_new: int, percent: int, forest: bool) -> list[tuple[int, int]]:
    """Candidate pairs among rows in order, with the second row at ``first_new`` or later.

    ``forest`` keeps one path between any two rows that candidates connect, by
    the best agreement of signatures; else all candidates are returned.
    """
    n = rows.num_rows
    if n < 2:
        return []
    label = np.frombuffer(b"".join(rows.column("_label").to_pylist()), np.uint8).reshape(n, HASHES)
    tree, node, comp, size = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("_tree", "_node", "_comp", "n_shingles"))
    differ = (label[1:] != label[:-1]) | (tree[1:] != tree[:-1])[:, None]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), HASHES)
    wanted = percent / 100
    agree = HASHES * wanted - SLACK * np.sqrt(HASHES * wanted * (1 - wanted))
    found, depth = [], shared.copy()
    for apart in range(1, min(REACH, n - 1) + 1):
        if apart > 1:
            depth = np.minimum(depth[:-1], shared[apart - 1:])
        left = np.flatnonzero(depth >= LEAST_DEPTH)
        if not len(left):
            break
        right = left + apart
        small, large = np.minimum(size[left], size[right]), np.maximum(size[left], size[right])
        open_ = (right >= first_new) & (comp[left] != comp[right]) & (100 * small >= percent * large)
        left, right = left[open_], right[open_]
        alike = (label[left] == label[right]).sum(axis=1)
        near = alike >= agree
        found.append(np.stack([alike[near], left[near], right[near]], axis=1))
    pairs = np.concatenate(found) if found else np.zeros((0, 3), int)
    if not forest:
        return [(int(node[a]), int(node[b])) for _, a, b in pairs]
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    kept = []
    for _, a, b in pairs[np.argsort(-pairs[:, 0], kind="stable")]:
        x, y = root(int(node[a])), root(int(node[b]))
        if x != y:
            parent[x] = y
            kept.append((int(node[a]), int(node[b])))
    return kept


def candidates(sets: DataFrame, percent: int, forest: bool) -> DataFrame:
    """Pairs ``a < b`` of nodes that are neighbours in one of the sorted orders and lie in different components.

    ``sets``: ``_node, _comp, n_shingles, _sig``, a row per distinct set. Without ``forest``, runs of more than
    REACH + 1 rows with LEAST_DEPTH common bytes are left to ``crowded``, which compares all their rows and reads a
    text once a block: here each row would bring up to REACH pairs of texts. In the other runs all pairs are met.
    """
    orders = F.explode(F.array(*[
        F.struct(F.lit(t).alias("_tree"), F.expr(f"concat(substring(_sig, {t * ORDER_STEP + 1}), substring(_sig, 1, {t * ORDER_STEP}))").alias("_label"))
        for t in range(ORDERS)]))
    rows = sets.select("_node", "_comp", "n_shingles", orders.alias("_o")).select("_node", "_comp", "n_shingles", "_o.*")
    if not forest:
        run_of = ["_tree", "_head"]
        rows = rows.withColumn("_head", F.substring("_label", 1, LEAST_DEPTH))
        full = stored(rows.groupBy(*run_of).agg(F.count("*").alias("_n")).where(f"_n > {REACH + 1}").select(*run_of))
        rows = rows.join(full, run_of, "left_anti").drop("_head")
    # Small tables get few partitions, so that all hold more than REACH rows.
    parts = max(1, min(shuffle_partitions(sets), sets.count() * ORDERS // (64 * REACH)))
    keys = ["_tree", "_label", "_node"]
    rows = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("_part", F.spark_partition_id())
    names = ["_node", "_comp", "n_shingles", "_tree", "_label"]

    def edge(rows: pa.Table, at: int) -> pa.Table:
        return rows.append_column("_edge", pa.array([at] * rows.num_rows, pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("_edge", pa.int32()), ("_node", pa.int64()), ("_comp", pa.int64()),
                          ("n_shingles", pa.int64()), ("_tree", pa.int32()), ("_label", pa.binary())])

        def out(pairs: list[tuple[int, int]] = (), rows: pa.Table | None = None) -> Iterator[pa.RecordBatch]:
            if pairs:
                ends = np.array(pairs, np.int64).reshape(-1, 2)
                n = len(ends)
                yield pa.RecordBatch.from_arrays([pa.array(ends.min(axis=1)), pa.array(ends.max(axis=1)), *[pa.nulls(n, f.type) for f in list(kind)[2:]]], schema=kind)
            if rows is not None and rows.num_rows:
                n = rows.num_rows
                table = pa.table([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), rows["_edge"], *[rows[c] for c in names]], schema=kind)
                yield from table.to_batches()

        held, part = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("_part")[0].as_py() if part is None else part
            fresh = pa.Table.from_batches([batch]).select(names)
            if held is None:
                yield from out(rows=edge(fresh.slice(0, REACH), part))
                block, new = fresh, 0
            else:
                block, new = pa.concat_tables([held, fresh]), held.num_rows
            yield from out(_near(block.combine_chunks(), new, percent, forest))
            held = block.slice(max(0, block.num_rows - REACH))
        if held is not None:
            yield from out(rows=edge(held, part + 1))

    schema = "a long, b long, _edge int, _node long, _comp long, n_shingles long, _tree int, _label binary"
    inside = settle(rows.mapInArrow(run, schema))

    def across(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("_tree", "ascending"), ("_label", "ascending"), ("_node", "ascending")])
        ends = np.array(_near(rows, 0, percent, forest), np.int64).reshape(-1, 2)
        return pa.table({"a": ends.min(axis=1), "b": ends.max(axis=1)})

    # At most 2 * REACH rows meet at each edge between two partitions.
    edges = inside.where("_edge is not null").select("_edge", *names).groupBy("_edge").applyInArrow(across, "a long, b long")
    return inside.where("a is not null").select("a", "b").union(edges).distinct()


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are similar: 100 * intersection >= percent * union.

    ``texts``: ``_id, _text`` for every node; both joins can be split where a node has many pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "_one"):
            linked: list[bool] = []
            for one, other in zip(batch.column("_one").to_pylist(), batch.column("_other").to_pylist()):
                x, y = shingle_set(one, words), shingle_set(other, words)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    one = texts.select(F.col("_id").alias("a"), F.col("_text").alias("_one"))
    other = texts.select(F.col("_id").alias("b"), F.col("_text").alias("_other"))
    return pairs.join(one, "a").join(other, "b").select("a", "b", "_one", "_other").mapInArrow(run, "a long, b long")


def sketch(shingles: np.ndarray) -> bytes:
    """Two bits of the smallest hash of the set under each of SKETCH_HASHES other functions, 32 to a word.

    Sharper than a signature: it tells sets that are well below the threshold
    from those that reach it, so that only these have to be read again.
    """
    random = np.random.default_rng(7)
    flip = random.integers(0, 1 << 63, SKETCH_HASHES, np.uint64)
    times = random.integers(0, 1 << 63, SKETCH_HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(SKETCH_HASHES, ~np.uint64(0))
    for at in range(0, len(shingles), 256):
        least = np.minimum(least, ((shingles[at:at + 256, None] ^ flip) * times).min(axis=0))
    bits = (least >> np.uint64(8)) & np.uint64(3)
    return (bits.reshape(-1, 32) << (np.arange(32, dtype=np.uint64) * np.uint64(2))).sum(axis=1, dtype=np.uint64).tobytes()


def sketches(plain: DataFrame, words: int) -> DataFrame:
    """``_node, _sketch`` of every row of ``plain`` (``_id, _text``); stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "_text"):
            made = [sketch(shingle_set(text, words)) for text in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(made, pa.binary())], names=["_node", "_sketch"])

    return stored(plain.mapInArrow(run, "_node long, _sketch binary"))


def _close(rows: pa.Table, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places of rows, each with the others of its block pair, or block, in another component whose sketches are as near as similar sets' are.

    A pair is judged only under the first head that its rows share, so it comes
    up once however many orders bring it together. (Where the run of an earlier
    shared head is not crowded, it was a candidate before.)
    """
    comp, size, side = (rows[c].to_numpy() for c in ("_comp", "n_shingles", "_side"))
    own = np.frombuffer(b"".join(rows["_sketch"].to_pylist()), np.uint64).reshape(len(comp), -1)
    heads = np.frombuffer(b"".join(rows["_heads"].to_pylist()), np.uint8).reshape(len(comp), ORDERS, LEAST_DEPTH)
    wanted = percent / 100 + (1 - percent / 100) / 4
    most_apart = SKETCH_HASHES * (1 - wanted) + SLACK * np.sqrt(SKETCH_HASHES * wanted * (1 - wanted))
    low = np.uint64(0x5555555555555555)
    two, earlier = rows["_left"][0].as_py() != rows["_right"][0].as_py(), rows["_tree"][0].as_py()
    left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if two else (np.arange(len(comp)),) * 2
    for k, x in enumerate(left):
        others = right if two else right[k + 1:]
        others = others[(comp[others] != comp[x]) & (100 * np.minimum(size[others], size[x]) >= percent * np.maximum(size[others], size[x]))]
        if earlier and len(others):
            others = others[~(heads[others, :earlier] == heads[x, :earlier]).all(axis=2).any(axis=1)]
        if len(others):
            differ = own[others] ^ own[x]
            apart = np.bitwise_count((differ | (differ >> np.uint64(1))) & low).sum(axis=1)
            if len(near := others[apart <= most_apart]):
                yield int(x), near


def _involved(rows: pa.Table, percent: int) -> pa.Table:
    """The rows that are close to any other: at most the block's rows, however many pairs they make."""
    near = np.zeros(rows.num_rows, bool)
    for x, others in _close(rows, percent):
        near[x] = near[others] = True
    return rows.filter(pa.array(near))


def _linked(rows: pa.Table, words: int, percent: int) -> pa.Table:
    """Links between close rows whose full sets are similar, but none between rows that others already connect."""
    node, comp = rows["_node"].to_pylist(), rows["_comp"].to_pylist()
    sets: dict[int, np.ndarray] = {}
    parent: dict[int, int] = {}
    links = []

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    def of(k: int) -> np.ndarray:
        if k not in sets:
            sets[k] = shingle_set(rows["_text"][k].as_py(), words)
        return sets[k]

    for x, others in _close(rows, percent):
        for y in others.tolist():
            one, other = top(comp[x]), top(comp[y])
            if one != other:
                both = len(np.intersect1d(of(x), of(y), assume_unique=True))
                if 100 * both >= percent * (len(of(x)) + len(of(y)) - both):
                    links.append((min(node[x], node[y]), max(node[x], node[y])))
                    parent[one] = other
    ends = np.array(links, np.int64).reshape(-1, 2)
    return pa.table({"a": ends[:, 0], "b": ends[:, 1]})


def crowded(sets: DataFrame, plain: DataFrame, words: int, percent: int) -> DataFrame | None:
    """Links between components among rows whose order has more than REACH others with LEAST_DEPTH common bytes.

    All of a run's rows in different components are compared, by sketches of
    128 bytes, in pairs of blocks of about BLOCK shingles; a component that
    fills blocks of its own isn't compared with itself, so a large group of
    copies costs its length. Only rows that are close to another go back to
    their blocks with their texts, and are compared in full there.

    ``sets``: ``_node, _comp, n_shingles, _sig``; ``plain``: ``_id, _text``, a row per document.
    """
    run, weight = ["_tree", "_head"], F.col("n_shingles") + 64
    heads = F.explode(F.array(*[
        F.struct(F.lit(t).alias("_tree"), F.expr(f"substring(_sig, {t * ORDER_STEP + 1}, {LEAST_DEPTH})").alias("_head")) for t in range(ORDERS)]))
    all_heads = F.concat(*[F.expr(f"substring(_sig, {t * ORDER_STEP + 1}, {LEAST_DEPTH})") for t in range(ORDERS)])
    rows = sets.select("_node", "_comp", "n_shingles", all_heads.alias("_heads"), heads.alias("_o")).select("_node", "_comp", "n_shingles", "_heads", "_o.*")
    of_comp = rows.groupBy(*run, "_comp").agg(F.count("*").alias("_n"), F.sum(weight).alias("_own"))
    few = F.sum(F.when(F.col("_own") <= BLOCK, F.col("_own")))
    runs = stored(of_comp.groupBy(*run).agg(F.sum("_n").alias("_all"), F.count("*").alias("_comps"), few.alias("_few")).where(f"_all > {REACH + 1} and _comps > 1"))
    if runs.isEmpty():
        return None
    large = F.col("_own") > BLOCK
    planned = stored(of_comp.join(runs.select(*run, "_few"), run).select(
        *run, "_comp", F.when(large, F.col("_comp").cast("string")).otherwise("few").alias("_owner"),
        F.ceil(F.when(large, F.col("_own")).otherwise(F.col("_few")) / BLOCK).cast("int").alias("_blocks")))
    name = lambda number: F.concat_ws("/", "_owner", number.cast("string"))
    blocks = planned.select(*run, "_owner", "_blocks").distinct().select(*run, "_owner", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_i"))
    blocks = stored(blocks.select(*run, "_owner", name(F.col("_i")).alias("_block")))
    left = blocks.select(*run, F.col("_owner").alias("_owner1"), F.col("_block").alias("_left"))
    right = blocks.select(*run, F.col("_owner").alias("_owner2"), F.col("_block").alias("_right"))
    pairs = stored(left.join(right, run).where("_left <= _right and (_owner1 = 'few' or _owner1 <> _owner2)").select(*run, "_left", "_right"))

    placed = rows.join(planned, [*run, "_comp"]).withColumn("_block", name(F.pmod(F.xxhash64("_node"), F.col("_blocks"))))
    nodes = stored(placed.select(F.col("_node").alias("_id")).distinct())
    texts = plain.join(nodes, "_id", "left_semi").distinct().withColumnRenamed("_id", "_node")
    kept = [*run, "_left", "_right", "_side", "_node", "_comp", "n_shingles", "_heads", "_sketch"]
    placed = placed.join(sketches(texts.withColumnRenamed("_node", "_id"), words), "_node")
    first = placed.withColumnRenamed("_block", "_left").join(pairs, [*run, "_left"]).withColumn("_side", F.lit(0)).select(*kept)
    second = placed.withColumnRenamed("_block", "_right").join(pairs.where("_left <> _right"), [*run, "_right"]).withColumn("_side", F.lit(1)).select(*kept)
    meeting = first.unionByName(second)
    near = stored(meeting.groupBy(*run, "_left", "_right").applyInArrow(lambda rows: _involved(rows, percent), meeting.schema))
    if near.isEmpty():
        return None
    read = near.join(texts, "_node").select(*kept, "_text")
    return read.groupBy(*run, "_left", "_right").applyInArrow(lambda rows: _linked(rows, words, percent), "a long, b long").distinct()


def _ties(found: DataFrame) -> DataFrame:
    """Links that connect what the components do, one a node."""
    return found.select(F.col("node").alias("a"), F.col("component").alias("b"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Classes of near-duplicate documents: ``doc_id, n_shingles, component_id, kept``, a row per row of ``docs``.

    Two documents are linked if 100 * intersection >= ``percent`` * union of
    their sets of ``words``-word shingles (lower-cased A-Z, ASCII white space);
    ``component_id`` is the smallest ``doc_id`` reachable, ``kept`` marks it.

    1. Documents with equal sets become one node before anything is compared.
    2. The nodes' signatures are sorted in several orders (an LSH forest). A
       node's candidates are the rows after it with a common prefix of
       LEAST_DEPTH bytes or more; in a crowded region at first the REACH next
       ones, which share the longest prefixes.
    3. First only a spanning forest of the candidates, best agreement first, is
       confirmed on the full sets; a group of m copies costs some m pairs.
    4. Then all candidates that still lie in different components are
       confirmed, but for those in runs of more than REACH + 1 rows.
    5. In these runs all rows of different components are compared by sketches,
       and the near ones of them on the full sets, so no candidate is left
       undecided.

    Texts without words have empty sets and are linked with nothing. Rows with
    a null id are linked with nothing, have a null component and are kept. Rows
    with equal id and text are one document: all or none of them is kept. Other
    columns are ignored; an empty table gives an empty result.
    """
    prints = stored(fingerprints(docs, words))
    named = prints.where("doc_id is not null and n_shingles > 0")
    sets = stored(named.groupBy("_d1", "_d2", "n_shingles").agg(F.min("doc_id").alias("_node"), F.first("_sig").alias("_sig")))

    pairs = settle(candidates(sets.withColumn("_comp", F.col("_node")), percent, forest=True))
    nodes = settle(pairs.select(F.explode(F.array("a", "b")).alias("_id")).distinct())
    plain = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").alias("_text"))
    texts = stored(plain.join(nodes, "_id", "left_semi").distinct())
    links = settle(confirmed(pairs, texts, words, percent))
    found = settle(components(links))

    near = sets.join(nodes, F.col("_node") == F.col("_id"), "left_semi")
    near = near.join(found.withColumnRenamed("node", "_node"), "_node", "left")
    near = stored(near.withColumn("_comp", F.coalesce("component", "_node")))
    rest = settle(candidates(near, percent, forest=False).join(pairs, ["a", "b"], "left_anti"))
    if not rest.isEmpty():
        found = settle(components(_ties(found).union(settle(confirmed(rest, texts, words, percent)))))

    joined = sets.join(found.withColumnRenamed("node", "_node"), "_node", "left").withColumn("_comp", F.coalesce("component", "_node"))
    more = crowded(stored(joined.select("_node", "_comp", "n_shingles", "_sig")), plain, words, percent)
    if more is not None and not (more := settle(more)).isEmpty():
        found = settle(components(_ties(found).union(more)))

    of_set = sets.join(found, F.col("_node") == F.col("node"), "left").select("_d1", "_d2", "n_shingles", F.coalesce("component", "_node").alias("_component"))
    all_ = prints.drop("_sig").join(of_set, ["_d1", "_d2", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    return all_.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each class of ``near_duplicates``, the one with the smallest id, with the columns it had.

    A document without an id is known by its text, after all that have one; of
    rows with equal id and text one stays. Texts without words are linked with
    nothing. Other columns are kept as they are; an empty table stays empty.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    unnamed = F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    key = F.coalesce(F.col("doc_id").cast("long"), unnamed)
    kept = near_duplicates(docs.select(key.alias("doc_id"), "text"), words, percent).where("kept").select(F.col("doc_id").alias("_kept"))
    known = docs.join(kept.distinct(), key == F.col("_kept"), "left_semi")
    # only rows whose key repeats are put together, so texts stay where they are
    repeated = kept.groupBy("_kept").agg(F.count("*").alias("_n")).where("_n > 1").select("_kept")
    single = known.join(repeated, key == F.col("_kept"), "left_anti").select(*columns)
    several = known.join(repeated, key == F.col("_kept"), "left_semi").select(*columns)
    return single.union(several.dropDuplicates(["doc_id", "text"]))
