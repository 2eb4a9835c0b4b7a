"""N-gram Jaccard join: documents whose sets of word shingles overlap enough, and their components.

The join is a sparse product of the document by shingle matrix with its transpose, cut down by
bounds that lose no pair:

1. One scan counts shingles into a sketch of fixed size and gives every document the size and the
   hash of its set. Documents with equal sets are one row of the matrix.
2. The sketch orders all shingles from rare to frequent (any common order is right, a rare-first
   order is fast). Two sets of sizes m and n can only reach the threshold if they share a shingle
   among the first m - ceil(t*m) + 1 and n - ceil(t*n) + 1, so only those columns enter the product.
3. Columns are dealt out by shingle and sorted. The first document of a column is its hub; overlap
   counts add up how many columns a document shares with a hub. Every document is checked against
   its best hub and its smallest one within the size bounds, unless parity sketches rule the pair
   out (documents whose sets differ in d shingles have sketches that differ in at most d bits): blocks of one hub row and up to
   ``HUB_BLOCK`` document rows of the whole matrix are multiplied, which adds up the exact overlaps,
   and pairs below the bound that their sizes give are discarded. A group of copies costs two
   checks a document.
4. Two documents of one column share its hub, so the pairs that are left lie within the documents
   of one hub. Where these belong to several components, pairs across components are held against
   the bounds of sizes and sketches, block by block inside the tasks. Of those that neither rules
   out, a block writes ``PICKS`` for each component (the likeliest ones and the first) to be multiplied
   exactly; then components are joined, and hubs of which pairs were held back go round again, until
   none are. Pairs in one component are linked already, by way of others, so near copies under a hub
   that isn't linked to them cost some pairs a document, not all pairs. A round that links nothing is
   followed by one that writes eight times as many. Hubs with more than ``CROSS_BLOCK`` documents are
   cut by set size first, as sets of too different sizes can't link; their first round compares
   documents within blocks and with the first document of their size, later ones all blocks.
   Documents that are all just short of the threshold (so that sketches can't tell) are checked pair by pair.
5. Components come from propagating the smallest id.

The sketch has more cells for larger inputs (4 to 16 MB of counts). At most 100,000 partitions hold the
columns; beyond that they grow, and what reads them is sorted and streamed.

Defined results: a null or empty text has an empty set and links with nothing; fewer words than a
shingle are one shingle; rows of one id are one document, of different texts the longest counts
(ties: the greater in bytes); an empty table gives no rows; other columns are not read, whatever
their names are. Ids are whole numbers (others raise). Each row with a null id stays a row, is linked with nothing and has a null component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veraz.llm.components import components
from veraz.llm.pieces import sized
from veraz.llm.shared import checkpoint, drop, giving_back, written
from veraz.llm.words import chunks, ngrams, word_hashes

WORDS, PERCENT = 5, 80
#: Cells of the shingle sketch: from 4 MB of counts for small inputs to 16 MB; bytes of text a cell stands for in between.
LEAST_CELL_BITS, MOST_CELL_BITS, CELL_TEXT = 20, 22, 32 << 10
BLOCK_BITS = 14
#: Bytes of texts that are turned into sets at a time.
TEXT_BYTES = 1 << 20
#: Columns of the matrix in one partition, about.
ENTRIES = 1 << 20
#: Documents that are checked against one hub in one block.
HUB_BLOCK = 512
#: Rows of one key from which on a broadcast tells them what belongs to the key, instead of a shuffle by it.
HOT_ROWS = 256
#: Documents in one block of those that share a hub.
CROSS_BLOCK = 1024
#: Pairs that a block writes for each component in the first round.
PICKS = 8
#: Logarithms of the fewest and the most cells of a document's parity sketch (128 bytes and 16 KB).
LEAST_PARITY, MOST_PARITY = 10, 17
#: Rows of a needed-document table up to which it is broadcast (24 bytes a row).
BROADCAST_ROWS = 400_000


def shingle_sets(texts: list[bytes], n: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    sets = []
    for a, b in chunks(texts):
        h, offsets = ngrams(*word_hashes(texts[a:b], fold=True), n)
        sets += [np.unique(h[i:j]) for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    return sets


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def parity(shingles: np.ndarray) -> bytes:
    """For each of some cells, whether an odd number of the shingles falls in it. There are two to four
    cells a shingle, so that sets of any size can be told apart; sketches of fewer cells are
    made from it by ``folded``."""
    cells = 1 << min(max((2 * len(shingles)).bit_length(), LEAST_PARITY), MOST_PARITY)
    counts = np.bincount((shingles & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return np.packbits(counts & 1).tobytes()


def folded(sketches: np.ndarray, width: int) -> np.ndarray:
    """Rows of 64-bit words of parity sketches, as if they had only so many words' cells."""
    while sketches.shape[1] > width:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def may_link(one: np.ndarray, n: int, others: list[np.ndarray] | np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which sets neither the sizes nor the parity sketches (rows of words) keep from linking with one."""
    both = n + sizes
    differ = both - 2 * -(-percent * both // (100 + percent))  # the most shingles in which sets that link differ
    fits = 100 * np.minimum(n, sizes) >= percent * np.maximum(n, sizes)
    widths = np.array([len(x) for x in others])
    for width in np.unique(widths[fits]).tolist():
        at = np.flatnonzero(fits & (widths == width))
        least = min(width, len(one))
        far = np.bitwise_count(folded(np.stack([others[i] for i in at.tolist()]), least) ^ folded(one[None], least)).sum(1)
        fits[at] = far <= differ[at]
    return fits


def _cell(h: np.ndarray, cells: int) -> np.ndarray:
    """The place of shingles among a power of two of cells."""
    return (h >> np.uint64(65 - cells.bit_length())).astype(np.int64)


def _cells(size: int) -> int:
    bits = max(1, -(-size // CELL_TEXT)).bit_length()
    return 1 << min(max(bits, LEAST_CELL_BITS), MOST_CELL_BITS)


def _bytes_in(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    if df.schema[id_col].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError(f"{id_col} must hold whole numbers; number the rows of a table with other ids first")
    return df.select(F.col(id_col).cast("long").alias("doc"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("text"))


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def _profile(n: int, cells: int):
    """Each document's set size and hash; at the end of a partition, the blocks of its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc", "n", "key", "parity", "block", "counts"]
        sketch = np.zeros(cells, np.uint32)
        for batch in sized(batches, 1, TEXT_BYTES):
            sets = shingle_sets(batch.column(1).to_pylist(), n)
            np.add.at(sketch, _cell(np.concatenate(sets), cells), 1) if sets else None
            keys = [set_key(s) for s in sets]
            empty = pa.nulls(len(sets))
            yield pa.record_batch([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array([parity(x) for x in sets], pa.binary()), empty.cast(pa.int32()), empty.cast(pa.binary())], names)
        blocks = sketch.reshape(-1, 1 << BLOCK_BITS)
        there = np.flatnonzero(blocks.any(1))
        empty = pa.nulls(len(there))
        yield pa.record_batch([empty.cast(pa.int64()), empty.cast(pa.int64()), empty.cast(pa.binary()), empty.cast(pa.binary()), pa.array(there, pa.int32()), pa.array([blocks[b].tobytes() for b in there], pa.binary())], names)

    return run


def _add_blocks(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(1 << BLOCK_BITS, np.uint64)
    for c in pdf["counts"]:
        total += np.frombuffer(c, np.uint32)
    return pd.DataFrame({"block": [pdf["block"].iloc[0]], "counts": [np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes()]})


def _prefixes(n: int, percent: int, sketch):
    """The first shingles of each document in the common order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = sketch.value, set()
        for batch in sized(batches, 1, TEXT_BYTES):
            ids, sets = batch.column(0).to_pylist(), shingle_sets(batch.column(1).to_pylist(), n)
            columns: list[list[np.ndarray]] = [[], [], []]
            for doc, s in zip(ids, sets, strict=True):
                key = set_key(s)
                if doc is None or not len(s) or key in seen:
                    continue  # an equal set of this partition stands for it
                seen.add(key)
                m = len(s)
                p = m - -(-percent * m // 100) + 1
                first = s[np.lexsort((s, counts[_cell(s, len(counts))]))[:p]]
                for column, value in zip(columns, (first.view(np.int64), np.full(p, doc), np.full(p, m)), strict=True):
                    column.append(value)
            if columns[0]:
                yield pa.record_batch([pa.array(np.concatenate(c), t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32()), strict=True)], ["h", "doc", "n"])

    return run


def _hubs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted columns -> for columns with two documents or more: hub, document, both sizes and in
    how many columns of this batch they meet. A hub is listed with itself."""
    last: tuple[int, int, int, bool] | None = None  # shingle, hub, its size, whether the hub is out
    for batch in batches:
        h, doc, n = (batch.column(i).to_numpy() for i in range(3))
        if not len(h):
            continue
        start = np.concatenate([[last is None or h[0] != last[0]], h[1:] != h[:-1]])
        where = np.maximum.accumulate(np.where(start, np.arange(len(h)), -1))
        hub, hub_n = (np.where(where < 0, last[k] if last else 0, v[np.maximum(where, 0)]) for k, v in ((1, doc), (2, n)))
        member = ~start
        lead = start & np.concatenate([member[1:], [False]])
        shown = member | lead
        found = np.stack([hub[shown], doc[shown], n[shown], hub_n[shown]])
        if last and not last[3] and not start[0]:
            found = np.concatenate([found, [[last[1]], [last[1]], [last[2]], [last[2]]]], 1)
        k = int(where[-1])
        last = (int(h[k]), int(doc[k]), int(n[k]), k < len(h) - 1) if k >= 0 else (*last[:3], True)
        if found.shape[1]:
            found = found[:, np.lexsort((found[1], found[0]))]
            first = np.concatenate([[True], (found[:2, 1:] != found[:2, :-1]).any(0)])
            times = np.diff(np.append(np.flatnonzero(first), found.shape[1]))
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.record_batch([pa.array(x, t) for x, t in zip((*found[:, first], times), types, strict=True)], ["hub", "doc", "n", "hub_n", "met"])


def _words(column: pa.Array) -> list[np.ndarray]:
    """Parity sketches as arrays of 64-bit words."""
    return [np.frombuffer(x, np.uint64) for x in column.to_pylist()]


def _picked(groups: np.ndarray, *ranks: np.ndarray, picks: int) -> np.ndarray:
    """Places of the first rows of each group in the order of ``ranks`` (last: ties)."""
    order = np.lexsort((*ranks[::-1], groups))
    groups = groups[order]
    start = np.concatenate([[True], groups[1:] != groups[:-1]])
    since = np.arange(len(order)) - np.maximum.accumulate(np.where(start, np.arange(len(order)), 0))
    return order[since < picks]


def _crossing(percent: int, picks: int):
    """Sorted blocks of documents that share a hub -> pairs (a, b) across components that neither the
    sizes nor the parity sketches rule out, some for each component; hubs with more of them."""

    def pairs(c, doc, n, side, guest, bits) -> tuple[np.ndarray, np.ndarray, bool]:
        """Both ends of the pairs, and whether some were held back."""
        order = np.lexsort((doc, c))
        c, doc, n, side, guest, bits = c[order], doc[order], n[order].astype(np.int64), side[order], guest[order], [bits[i] for i in order.tolist()]
        whole = (side == side[0]).all()
        # Sketches of one width are rows of one matrix; each is also kept folded once, as sizes within
        # the bound have widths that differ by one step at most.
        widths = np.array([len(x) for x in bits])
        rows = {w: np.flatnonzero(widths == w) for w in np.unique(widths).tolist()}
        place = np.empty(len(bits), np.int64)
        for at in rows.values():
            place[at] = np.arange(len(at))
        full = {w: np.stack([bits[i] for i in at.tolist()]) for w, at in rows.items()}
        half = {w: folded(m, w // 2) for w, m in full.items() if w // 2 in full}
        ahead: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # one end, the other, how far below the bound
        best, by, first = np.full(len(c), np.iinfo(np.int64).max), np.full(len(c), -1), np.full(len(c), -1)
        held_back = False
        for i in range(len(c) - 1):
            j = int(np.searchsorted(c, c[i], side="right"))  # sorted by component: what follows differs
            if j == len(c):
                break
            both = n[i] + n[j:]
            differ = both - 2 * -(-percent * both // (100 + percent))
            fits = 100 * np.minimum(n[j:], n[i]) >= percent * np.maximum(n[j:], n[i])
            if not whole:
                fits &= side[j:] != side[i]
            if guest[i]:
                fits &= ~guest[j:]  # two guests meet in their own class
            own = int(widths[i])
            others, margins = [], []
            for w, m in full.items():
                at = np.flatnonzero(fits & (widths[j:] == w))
                if not len(at):
                    continue
                if w > 2 * own or own > 2 * w:  # a percentage so low that sizes differ by more than a step
                    least = min(w, own)
                    far = np.bitwise_count(folded(m[place[j + at]], least) ^ folded(bits[i][None], least)).sum(1)
                else:
                    that = (half if w > own else full)[w][place[j + at]]
                    this = half[own][place[i]] if w < own else full[own][place[i]]
                    far = np.bitwise_count(that ^ this).sum(1)
                margin = far.astype(np.int64) - differ[at]
                others.append(j + at[margin <= 0])
                margins.append(margin[margin <= 0])
            other = np.concatenate(others) if others else np.zeros(0, np.int64)
            if not len(other):
                continue
            margin = np.concatenate(margins)
            better = margin < best[other]
            best[other[better]], by[other[better]] = margin[better], i
            first[other[first[other] < 0]] = i
            if len(other) > picks:
                held_back = True
                nearest = np.argpartition(margin, picks - 1)[:picks]
                nearest = np.append(nearest, int(other.argmin()))
                other, margin = other[nearest], margin[nearest]
            ahead.append((np.full(len(other), i), other, margin))
        if not ahead:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), False
        one, other, margin = (np.concatenate(x) for x in zip(*ahead, strict=True))
        if held_back or len(one) > picks * len(np.unique(c)):
            least = _picked(c[one], margin, other, picks=picks)
            smallest = _picked(c[one], other, one, picks=1)
            reached = np.flatnonzero(by >= 0)
            back = reached[_picked(c[reached], best[reached], by[reached], picks=1)]
            early = reached[_picked(c[reached], first[reached], reached, picks=1)]
            kept = np.concatenate([least, smallest])
            held_back = held_back or len(np.unique(kept)) < len(one)
            one, other = np.concatenate([one[kept], by[back], first[early]]), np.concatenate([other[kept], back, early])
        return doc[one], doc[other], held_back

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: set[tuple[int, int]] = set()
        held: list[tuple] = []
        group = None

        def flush() -> Iterator[pa.RecordBatch]:
            *columns, bits = zip(*held, strict=True)
            x, y, more = pairs(*(np.concatenate(x) for x in columns), [b for block in bits for b in block])
            new = set(zip(np.minimum(x, y).tolist(), np.maximum(x, y).tolist(), strict=True)) - recent
            if len(recent) > 500_000:
                recent.clear()
            recent.update(new)
            a, b, hubs = [p[0] for p in new], [p[1] for p in new], [None] * len(new)
            if more:
                a, b, hubs = [*a, None], [*b, None], [*hubs, int(group[0])]
            if a:
                yield pa.record_batch([pa.array(v, pa.int64()) for v in (a, b, hubs)], ["a", "b", "more"])

        for batch in _slices(batches):
            hub, group_, lo, hi, side, c, doc, n = (batch.column(i).to_numpy() for i in range(8))
            guest, bits = batch.column(8).to_numpy(zero_copy_only=False), _words(batch.column(9))
            cuts = [0, *(np.flatnonzero((hub[1:] != hub[:-1]) | (group_[1:] != group_[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1).tolist(), len(hub)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if held and group != (hub[a], group_[a], lo[a], hi[a]):
                    yield from flush()
                    held = []
                group = (hub[a], group_[a], lo[a], hi[a])
                held.append((*(x[a:b] for x in (c, doc, n, side, guest)), bits[a:b]))
        if held:
            yield from flush()

    return run


def _by_hub(batch: pa.RecordBatch, hub: int | None) -> Iterator[tuple[int, int, int | None]]:
    """Ranges of rows of one hub, without the hub's own row, and the place of that row in the batch; None: it
    was in an earlier batch."""
    hubs, docs = (batch.column(i).to_numpy() for i in (0, 2))
    lead = np.flatnonzero(hubs == docs).tolist()
    for a, b in zip([0, *lead], [*lead, len(hubs)], strict=True):
        own = a if a < b and hubs[a] == docs[a] else None
        if (hubs[a:b] != (hub if own is None else hubs[own])).any():
            raise ValueError("a block without its hub")
        if a < b:
            hub = int(hubs[a])
            yield (a if own is None else a + 1), b, own


def _bounded(percent: int):
    """Blocks of a hub's set size and parity sketch and others' -> the pairs that these don't rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own, size = None, np.zeros(0, np.uint64), 0
        for batch in _slices(batches):
            docs, n, bits, found = batch.column(2).to_numpy(), batch.column(3).to_numpy(), _words(batch.column(4)), []
            for a, b, lead in _by_hub(batch, hub):
                if lead is not None:
                    hub, own, size = int(docs[lead]), bits[lead], int(n[lead])
                if a < b:
                    found += [(hub, int(d)) for d in docs[a:b][may_link(own, size, bits[a:b], n[a:b], percent)]]
            if found:
                yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], ["a", "b"])

    return run


def overlaps(row: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """One row of the matrix times others: how many shingles of ``row``, sorted, each of the others holds."""
    if not len(row) or not rows:
        return np.zeros(len(rows), np.int64)
    entries = np.concatenate(rows)
    met = row[np.minimum(np.searchsorted(row, entries), len(row) - 1)] == entries
    return np.bincount(np.repeat(np.arange(len(rows)), [len(r) for r in rows]), weights=met, minlength=len(rows)).astype(np.int64)


def _checked(n: int, percent: int):
    """Blocks of a hub's text and other texts -> the links among them, by exact overlap counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, np.zeros(0, np.uint64)
        for batch in sized(batches, 3, TEXT_BYTES):
            docs, sets, links = batch.column(2).to_numpy(), shingle_sets(batch.column(3).to_pylist(), n), []
            for a, b, lead in _by_hub(batch, hub):
                if lead is not None:
                    hub, own = int(docs[lead]), sets[lead]
                if a < b:
                    size = len(own) + np.array([len(x) for x in sets[a:b]])
                    overlap = overlaps(own, sets[a:b])
                    links += [(hub, int(d)) for d in docs[a:b][(overlap > 0) & (100 * overlap >= percent * (size - overlap))]]
            if links:
                yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*links, strict=True)], ["a", "b"])

    return run


def _told(rows: DataFrame, table: DataFrame, on: list[str], count: str) -> DataFrame:
    """Rows joined to a checkpointed table with one row a key that says how many rows the key has. Those
    of frequent keys stay where they are: their part of the table is broadcast, if it is small."""
    hot = table.where(F.col(count) > HOT_ROWS)
    if hot.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return rows.join(table, on)
    known = rows.join(F.broadcast(hot), on, "left")
    rest = known.where(F.col(count).isNull()).select(rows.columns).join(table.where(F.col(count) <= HOT_ROWS), on)
    return known.where(F.col(count).isNotNull()).unionByName(rest)


def _dealt(pairs: DataFrame, rows: DataFrame, parts: int) -> DataFrame:
    """Pairs (a, b) as blocks of a hub, first, and up to about ``HUB_BLOCK`` others: a, block, doc and the other columns of rows."""
    sized = _told(pairs, checkpoint(pairs.groupBy("a").agg(F.count("*").alias("times"))), ["a"], "times")
    members = sized.select("a", F.expr(f"cast(pmod(xxhash64(b), ceil(times / {HUB_BLOCK})) as int)").alias("block"), F.col("b").alias("doc"))
    need = checkpoint(members.unionByName(members.select("a", "block").distinct().withColumn("doc", F.col("a"))))
    if need.count() <= BROADCAST_ROWS:
        need = F.broadcast(need)
    told = rows.join(need, "doc").select("a", "block", "doc", *(c for c in rows.columns if c != "doc"))
    return told.repartition(parts, "a", "block").sortWithinPartitions("a", "block", (F.col("a") == F.col("doc")).desc())


def _links(pairs: DataFrame, texts: DataFrame, n: int, percent: int, parts: int) -> DataFrame:
    """The pairs (a, b) of distinct documents whose sets overlap enough."""
    return _dealt(pairs, texts, parts).mapInArrow(giving_back(_checked(n, percent)), "a long, b long")


def _sides(placed: DataFrame, mixed: DataFrame, percent: int, within: bool) -> DataFrame:
    """Documents of hubs with several components as blocks (hub, group, lo, hi). ``within``: large hubs
    only meet within blocks, each with the first document of the group."""
    # Classes of sizes that are a little wider than the sizes of two sets that link can differ; a large
    # hub is cut into groups of a class and, as guests, the class above it.
    width = np.log(100 / percent) * 1.0001 if percent < 100 else 1e-9
    members = _told(placed, mixed, ["hub"], "members").withColumn("_class", F.when(F.col("members") > CROSS_BLOCK, F.floor(F.log(F.col("n").cast("double")) / width)).otherwise(0).cast("long"))
    guests = members.where(F.col("members") > CROSS_BLOCK).select("hub", "c", "doc", "n", "members", (F.col("_class") - 1).alias("group"), F.lit(True).alias("guest"))
    members = members.select("hub", "c", "doc", "n", "members", F.col("_class").alias("group"), F.lit(False).alias("guest")).unionByName(guests)
    own = F.when(~F.col("guest") & (F.col("doc") != F.col("hub")), F.col("doc"))
    sizes = checkpoint(members.where(F.col("members") > CROSS_BLOCK).groupBy("hub", "group").agg(F.count("*").alias("times"), F.min(own).alias("lead")))
    small = members.where(F.col("members") <= CROSS_BLOCK).withColumns({"times": F.lit(1).cast("long"), "lead": F.lit(None).cast("long")})
    sides = small.unionByName(_told(members.where(F.col("members") > CROSS_BLOCK), sizes, ["hub", "group"], "times").select(small.columns))
    sides = sides.withColumn("blocks", F.expr(f"cast(ceil(times / {CROSS_BLOCK}) as int)")).withColumn("side", F.expr("cast(pmod(xxhash64(doc), blocks) as int)"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    if within:
        sides = sides.withColumn("other", F.explode(F.when(F.col("doc") == F.col("lead"), every).otherwise(F.array("side")))).withColumn("side", F.col("other"))
    else:
        sides = sides.withColumn("other", F.explode(every))
    return sides.select("hub", "group", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "side", "c", "doc", F.col("n").cast("long"), "guest")


def join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: ``id_col``, n_shingles long, component_id long (the smallest document
    reachable by links, itself included)."""
    spark, texts = df.sparkSession, _bytes_in(df, id_col, text_col)
    read = texts.groupBy("doc").agg(F.sum(F.octet_length("text")).alias("size"), F.min(F.xxhash64("text")).alias("lo"), F.max(F.xxhash64("text")).alias("hi"))
    read = read.agg(F.sum("size").alias("size"), F.count_if(F.expr("doc is not null and lo <> hi")).alias("torn")).first()
    cells = _cells(read["size"] or 0)
    if read["torn"]:
        own = texts.where("doc is not null").groupBy("doc").agg(F.max(F.struct(F.octet_length("text").alias("l"), "text")).alias("t")).select("doc", "t.text")
        texts = written(own.unionByName(texts.where("doc is null")))
    profile = written(texts.mapInArrow(giving_back(_profile(words, cells)), "doc long, n long, key binary, parity binary, block int, counts binary"))
    documents = profile.where("block is null").select("doc", "n", "key")
    sketch = np.zeros(cells, np.uint32)
    for r in profile.where("block is not null").select("block", "counts").groupBy("block").applyInPandas(_add_blocks, "block int, counts binary").collect():
        sketch[r.block << BLOCK_BITS : (r.block + 1) << BLOCK_BITS] = np.frombuffer(r["counts"], np.uint32)
    shared = spark.sparkContext.broadcast(sketch)

    size = documents.agg(F.sum("n")).first()[0] or 0
    parts = max(2, min(100_000, -(-size * (100 - percent) // 100 // ENTRIES) * 2))
    entries = texts.mapInArrow(giving_back(_prefixes(words, percent, shared)), "h long, doc long, n int")
    met = entries.repartition(parts, "h").sortWithinPartitions("h", "doc").mapInArrow(giving_back(_hubs), "hub long, doc long, n int, hub_n int, met int")
    near = written(met.groupBy("hub", "doc").agg(F.max("n").alias("n"), F.max("hub_n").alias("hub_n"), F.sum("met").alias("met")))
    sized = near.where(F.expr(f"doc <> hub and 100 * least(n, hub_n) >= {percent} * greatest(n, hub_n)"))
    best = sized.groupBy("doc").agg(F.max(F.struct("met", (-F.col("hub")).alias("neg"))).alias("m"), F.min("hub").alias("first"))
    hub_pairs = checkpoint(best.select(F.explode(F.array_distinct(F.array(-F.col("m.neg"), "first"))).alias("a"), F.col("doc").alias("b")))
    sketches = profile.where("block is null and n > 0 and doc is not null").groupBy("doc").agg(F.max(F.struct("n", "parity")).alias("s")).select("doc", "s.n", "s.parity")
    possible = checkpoint(_dealt(hub_pairs, sketches, parts).mapInArrow(giving_back(_bounded(percent)), "a long, b long").distinct())
    first = checkpoint(_links(possible, texts, words, percent, parts))

    # Documents with equal sets are one: the smallest of them.
    filled = documents.where("n > 0 and doc is not null")
    same = checkpoint(filled.groupBy("key").agg(F.min("doc").alias("rep"), F.max("doc").alias("other"), F.count("*").alias("times")).where("rep <> other").drop("other"))
    found = _told(filled, same, ["key"], "times")
    copies = checkpoint(found.select("doc", "rep").where("doc <> rep").distinct())

    def on_reps(links: DataFrame) -> DataFrame:
        for end in ("a", "b"):
            c = copies.select(F.col("doc").alias(end), "rep")
            links = links.join(c, end, "left").withColumn(end, F.coalesce("rep", end)).drop("rep")
        return links.where("a <> b").distinct()

    linked = checkpoint(on_reps(first))
    labels = components(linked)
    todo, tried, picks, within = None, None, PICKS, True
    while True:
        of_doc = copies.select("doc", "rep").unionByName(labels.select(F.col("node").alias("doc"), F.col("node").alias("rep"))).join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left").select(F.col("doc").alias("d"), F.coalesce("component", "rep").alias("c"))
        there = near if tried is None else near.join(todo if todo.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS else F.broadcast(todo), "hub", "left_semi")
        placed = written(there.join(of_doc, F.col("doc") == F.col("d"), "left").select("hub", F.coalesce("c", "doc").alias("c"), "doc", "n"))
        mixed = checkpoint(placed.groupBy("hub").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("members")).where("lo <> hi").select("hub", "members"))
        crossing = _sides(placed, mixed, percent, within)
        crossing = crossing.join(sketches.select("doc", "parity"), "doc").select(*crossing.columns, "parity")
        out = checkpoint(crossing.repartition(parts, "hub", "group", "lo", "hi").sortWithinPartitions("hub", "group", "lo", "hi").mapInArrow(giving_back(_crossing(percent, picks)), "a long, b long, more long").distinct())
        drop(placed)
        pairs = out.where("a is not null").select("a", "b")
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = checkpoint(pairs)
        new = False
        if pairs.limit(1).count():
            found = checkpoint(on_reps(_links(pairs, texts, words, percent, parts)))
            new = found.limit(1).count() > 0
        todo = out.where("more is not null").select(F.col("more").alias("hub"))
        if within:
            todo = todo.unionByName(mixed.where(F.col("members") > CROSS_BLOCK).select("hub"))
        todo = checkpoint(todo.distinct())
        if new:
            linked = checkpoint(linked.unionByName(found))
            labels = components(linked)
        if not todo.limit(1).count():
            break
        if not new and not within:
            picks *= 8
        tried = pairs if tried is None else checkpoint(tried.unionByName(pairs))
        within = False
    known = documents.where("doc is not null").distinct().join(copies, "doc", "left").withColumn("rep", F.coalesce("rep", "doc")).join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left")
    final = known.select("doc", "n", F.coalesce("component", "rep").alias("c")).unionByName(documents.where("doc is null").select("doc", "n", F.lit(None).cast("long").alias("c")))
    return final.select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), F.col("c").alias("component_id"))
