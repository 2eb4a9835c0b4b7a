"""CSV records with line ends inside quotes, read by many tasks a file.

Spark cuts a file into byte ranges and gives the lines that begin in each. Where a line begins, a
reader is either at a record's start or inside a quoted value, and what a line does to that state is
one of four functions (keep, swap, start, inside), which an expression finds. A first pass puts the
functions of each range together; the driver then knows, in file order, in which state every range
begins: one row for each range with quotes (128 MB by default), whatever the records are. A second
pass joins lines to records, range by range and batch by batch. A record across a border leaves one
piece in each range; these few pieces are put together by file and place, from the ranges that have
any. Values are parsed by Spark's own CSV expression.

Quotes follow the CSV reader: they open a value only at its start, two are one inside, and behind a
closing one the rest counts up to the delimiter. Line ends are ``\\n``, or ``\\r\\n`` in files whose first line
ends so, where those inside values become ``\\n`` too; texts are UTF-8. Each file's first record that isn't empty is its header and lies in the file's first range; empty lines
between records are left out.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What a line does to the state: it ends at a record's start, turns one state into the other, keeps it, or ends inside a value.
START, SWAP, KEEP, INSIDE = range(4)
WHOLE, CONTINUED, OPEN, HEADER = "inteiro", "continuacao", "aberto", "cabecalho"
_PIECES = "arquivo long, bloco long, tipo string, registro string"
_MARK = "﻿"


def ends_inside(line: Column, delimiter: str = ",") -> Column:
    """Whether a record's text so far ends inside a quoted value. Possessive, so without backtracking."""
    not_delimiter, quoted = rf"[^\x{{{ord(delimiter):x}}}]*+", r'"[^"]*+(?:""[^"]*+)*+'
    return line.rlike(rf'\A(?:(?:{quoted}"{not_delimiter}|(?!"){not_delimiter})\x{{{ord(delimiter):x}}})*+{quoted}\z')


def effect(line: Column, delimiter: str = ",") -> Column:
    """The function of a line. Inside a value, the line is as one that begins with a quote."""
    from_inside = F.when(ends_inside(F.concat(F.lit('"'), line), delimiter), F.lit(KEEP)).otherwise(F.lit(START))
    from_start = F.when(ends_inside(line, delimiter), F.lit(SWAP)).otherwise(F.lit(START))
    return F.when(F.instr(line, '"') == 0, F.lit(KEEP)).otherwise(from_start + from_inside).cast("byte")


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The lines of files, with a hash of the file's path and where their range begins."""
    rows = spark.read.option("lineSep", "\n").text(path).select(F.xxhash64("_metadata.file_path").alias("arquivo"), F.col("_metadata.file_block_start").alias("bloco"), F.col("value").alias("linha"))
    return rows.withColumn("linha", F.when((F.col("bloco") == 0) & F.startswith("linha", F.lit(_MARK)), F.substring("linha", 2, 2**31 - 1)).otherwise(F.col("linha")))


def states(effects: np.ndarray, inside: bool) -> np.ndarray:
    """Whether the reader is inside a value before each line and after the last: what the last line that
    fixes the state says, swapped once for each later line that swaps it."""
    e = np.concatenate([[INSIDE if inside else START], effects])
    fixing = np.maximum.accumulate(np.where((e == START) | (e == INSIDE), np.arange(len(e)), 0))
    swaps = np.cumsum(e == SWAP)
    return (e[fixing] == INSIDE) ^ ((swaps - swaps[fixing]) % 2 == 1)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """The batch, cut where the file or the range changes."""
    files, blocks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    cuts = [0, *(np.flatnonzero((blocks[1:] != blocks[:-1]) | (files[1:] != files[:-1])) + 1).tolist(), len(blocks)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield (int(files[a]), int(blocks[a])), batch.slice(a, b - a)


def _range_effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each range: the states at its end, for either at its beginning, and the end of its first line."""
    ends: dict[tuple[int, int], tuple[bool, bool]] = {}
    returns: dict[tuple[int, int], bool] = {}
    for batch in batches:
        for key, part in _runs(batch):
            lines = part.column(2).to_numpy()
            returns.setdefault(key, part.column(3)[0].as_py())
            ends[key] = tuple(bool(states(lines, s)[-1]) for s in ends.get(key, (False, True)))
    rows = [(f, b, *e, returns[f, b]) for (f, b), e in ends.items()]
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_())
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * 5, kinds, strict=True)], names=["arquivo", "bloco", "de_inicio", "de_dentro", "retorno"])


class Borders:
    """In which state ranges begin: for each file the places of ranges behind which the state changes.
    ``returns`` are the files whose lines end with carriage returns."""

    def __init__(self, ends: list[tuple[int, int, bool, bool, bool]]):
        self.changes: dict[int, list[int]] = {}
        self.returns = {file for file, block, *_, returns in ends if returns and not block}
        inside, before = False, None
        for file, block, from_start, from_inside, _ in sorted(ends):
            inside = inside and file == before
            after = from_inside if inside else from_start
            if after != inside:
                self.changes.setdefault(file, []).append(block)
            inside, before = after, file

    def inside(self, file: int, block: int) -> bool:
        return bisect_left(self.changes.get(file, ()), block) % 2 == 1

    def crossed(self) -> list[tuple[int, int, int]]:
        """(file, first range, last range) of stretches of ranges whose borders lie inside values."""
        out = []
        for file, blocks in self.changes.items():
            ends = [*blocks[1::2], *([2**63 - 1] if len(blocks) % 2 else [])]
            out += [(file, a, b) for a, b in zip(blocks[::2], ends, strict=True)]
        return out


def _joined(batches: Iterator[pa.RecordBatch], borders: Borders, whole: bool) -> Iterator[pa.RecordBatch]:
    """The records of each range (file, text) but headers and empty ones; or, not ``whole``, the pieces of
    those that cross its borders (file, range, kind, text)."""
    key, inside, held, continues, header = None, False, [], False, False

    def piece(kind: str) -> Iterator[pa.RecordBatch]:
        nonlocal held, header
        text = "\n".join(x for lines in held for x in lines.to_pylist())
        named = header and kind != CONTINUED and bool(text)
        header, held = header and not named, []
        if whole and kind == WHOLE and text and not named:
            yield pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([text])], names=["arquivo", "registro"])
        elif not whole and kind != WHOLE:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (key[0], key[1], HEADER if named else kind, text)], names=["arquivo", "bloco", "tipo", "registro"])

    for batch in batches:
        for at, part in _runs(batch):
            if at != key:
                if held:
                    yield from piece(CONTINUED if continues else OPEN)
                key, held, header = at, [], at[1] == 0
                inside = continues = borders.inside(*at)
            lines, before = part.column(2), states(part.column(3).to_numpy(), inside)
            if key[0] in borders.returns:
                lines = pc.replace_substring_regex(lines, r"\r\z", "")
            inside = bool(before[-1])
            begins = np.flatnonzero(~before[:-1])
            first = int(begins[0]) if len(begins) else len(lines)
            if first:
                held.append(lines.slice(0, first))
            if held and (first < len(lines) or not inside):  # what was open ends here
                yield from piece(CONTINUED if continues else WHOLE)
                continues = False
            if not len(begins):
                continue
            if inside:
                held = [lines.slice(int(begins[-1]))]
            edges = begins if inside else np.append(begins, len(lines))
            if len(edges) < 2 or not (whole or header):
                continue
            found = lines.slice(int(edges[0]), int(edges[-1] - edges[0]))
            if len(edges) - 1 < len(found):
                found = pc.binary_join(pa.ListArray.from_arrays(pa.array(edges - edges[0], pa.int32()), found), "\n")
            filled = pc.binary_length(found).to_numpy() > 0
            if header and filled.any():
                filled[np.argmax(filled)] = header = False
            if whole:
                if not filled.all():
                    found = found.filter(pa.array(filled))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), key[0])), found], names=["arquivo", "registro"])
    if held:
        yield from piece(CONTINUED if continues else OPEN)


def _stitched(pieces: DataFrame) -> DataFrame:
    """Records from the pieces of several ranges: an open one and what continues it."""
    opens = F.col("tipo") != CONTINUED
    numbered = pieces.withColumn("n", F.sum(opens.cast("int")).over(Window.partitionBy("arquivo").orderBy("bloco", opens)))
    parts = F.array_sort(F.collect_list(F.struct("bloco", "registro")))
    put = numbered.groupBy("arquivo", "n").agg(F.bool_or(F.col("tipo") == HEADER).alias("cabecalho"), F.array_join(F.transform(parts, lambda p: p["registro"]), "\n").alias("registro"))
    return put.where("not cabecalho").select("arquivo", "registro")


def records(spark: SparkSession, path: str | list[str], delimiter: str = ",") -> DataFrame:
    """(arquivo, registro): the text of every record but headers, with a hash of its file's path."""
    marked = _lines(spark, path).withColumn("efeito", effect(F.col("linha"), delimiter))
    telling = marked.where((F.instr("linha", '"') > 0) | (F.col("bloco") == 0)).select("arquivo", "bloco", "efeito", F.endswith("linha", F.lit("\r")).alias("retorno"))
    ends = telling.mapInArrow(_range_effects, "arquivo long, bloco long, de_inicio boolean, de_dentro boolean, retorno boolean")
    borders = Borders([tuple(r) for r in ends.collect()])  # a row for each range with quotes
    whole = marked.mapInArrow(lambda b: _joined(b, borders, True), "arquivo long, registro string")
    if crossed := borders.crossed():
        where = spark.createDataFrame(crossed, "_arquivo long, primeiro long, ultimo long")  # one row a border at most
        touched = marked.join(F.broadcast(where), (F.col("arquivo") == F.col("_arquivo")) & F.col("bloco").between(F.col("primeiro"), F.col("ultimo")), "left_semi")
        whole = whole.unionByName(_stitched(touched.mapInArrow(lambda b: _joined(b, borders, False), _PIECES)))
    return whole


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def read_records(spark: SparkSession, path: str | list[str], columns: list[str], delimiter: str = ",", file_column: str | None = None) -> DataFrame:
    """All rows of files with one header, as strings; ``file_column`` names a column with the file of each row."""
    parsed = F.from_csv("registro", ", ".join(f"{quoted(c)} string" for c in columns), {"escape": '"', "sep": delimiter, "multiLine": "true", "maxColumns": "20480"})
    rows = records(spark, path, delimiter).select("arquivo", parsed.alias("valores"))
    chosen = [F.col(f"valores.{quoted(c)}").alias(c) for c in columns]
    if not file_column:
        return rows.select(*chosen)
    names = spark.read.format("binaryFile").load(path).select(F.xxhash64("_metadata.file_path").alias("_arquivo"), F.col("_metadata.file_path").alias("nome"))  # a row a file
    return rows.join(F.broadcast(names), F.col("arquivo") == F.col("_arquivo")).select(*chosen, F.col("nome").alias(file_column))
