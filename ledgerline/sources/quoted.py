"""CSV with quoted newlines, read by many tasks.

A quoted field may hold line breaks, so whether a line starts a record depends on everything before
it in its file. Reading such a file as one piece keeps one task busy for its whole length. Here
each line is taken as a function on two states, *outside* or *inside* a quoted field: where it ends if it starts
outside, and where if it starts inside. Functions of consecutive lines combine, so

1. one pass over the file's splits gives each split's function (a row per split);
2. the functions are chained in file order, which tells the state that each split starts in; that
   small table (a row per ``spark.sql.files.maxPartitionBytes`` of input: about 800,000 rows
   for 100 TB) is broadcast;
3. a second pass joins the lines of each record. A record that lies in one split is finished
   there; the pieces of a record cut by a split's border (at most two a split) meet in a small
   shuffle and are put together in file order.

A line's function follows RFC fields: a quote opens a field only at its start, a doubled quote
inside is text, and a quote within an unquoted field is text too, as the whole-file reader
has it. Lines end with a line feed; in a file whose first line ends with a carriage return before it, all
line breaks lose theirs, inside quotes too. Blank lines between records are skipped, a byte-order mark is
dropped, and every file's first record is its header.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

OUTSIDE, INSIDE = 0, 1
#: Behind a quoted field's closing quote, or within an unquoted field: up to the next separator.
_REST = r'[^,]*+'
_FIELDS = re.compile(rf'(?:,(?:"[^"]*+(?:""[^"]*+)*+"{_REST}|(?!"){_REST}))*+')
_FIRST = re.compile(rf'"[^"]*+(?:""[^"]*+)*+"{_REST}|(?!"){_REST}')
_CLOSES = re.compile(rf'[^"]*+(?:""[^"]*+)*+"{_REST}')

PIECES = "file string, split long, part int, opens boolean, header boolean, record string"


def end_state(line: str, start: int) -> int:
    """The state behind a line that starts in state ``start``."""
    first = (_CLOSES if start == INSIDE else _FIRST).match(line)
    if first is None:  # no closing quote: inside to the end
        return INSIDE
    return OUTSIDE if _FIELDS.match(line, first.end()).end() == len(line) else INSIDE


def without_mark(line: str) -> str:
    """A file's first line without a byte-order mark."""
    return line.removeprefix("\ufeff")


def _lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """Lines with their file and split, in order within a task."""
    code = encoding.upper().replace("-", "").replace("_", "")
    if code not in ("UTF8", "ISO88591"):
        raise ValueError(f"lines cannot be told apart in {encoding}")
    text = F.make_valid_utf8("value") if code == "UTF8" else F.decode(F.col("value").cast("binary"), encoding)
    return spark.read.format("text").option("lineSep", "\n").load(path).select(
        text.alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"))


def split_functions(lines: DataFrame) -> DataFrame:
    """(file, split, from_outside, from_inside, returns): each split's function, lines taken in order,
    and whether its first line ends with a carriage return."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, states, returns, out = None, [OUTSIDE, INSIDE], False, []
        for batch in batches:
            quoted = pa.compute.match_substring(batch.column("line"), '"').to_pylist()
            for line, file, split, some in zip(batch.column("line").to_pylist(), batch.column("file").to_pylist(), batch.column("split").to_pylist(), quoted):
                if (file, split) != now:
                    if now:
                        out.append((*now, *states, returns))
                    now, states, returns = (file, split), [OUTSIDE, INSIDE], line.endswith("\r")
                    line = without_mark(line) if split == 0 else line
                if some:  # a line without quotes leaves every state as it is
                    states = [end_state(line, s) for s in states]
        if now:
            out.append((*now, *states, returns))
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
        columns = list(zip(*out)) or [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                         names=["file", "split", "from_outside", "from_inside", "returns"])

    return lines.mapInArrow(run, "file string, split long, from_outside int, from_inside int, returns boolean")


def start_states(functions: DataFrame) -> dict[tuple[str, int], tuple[int, bool]]:
    """The state that each split starts in (every file starts outside), and whether its file's lines
    end with carriage returns."""
    out, state, file, returns = {}, OUTSIDE, None, False
    for r in functions.orderBy("file", "split").toLocalIterator():  # a row per split
        if r["file"] != file:
            file, state, returns = r["file"], OUTSIDE, r["returns"]
        out[r["file"], r["split"]] = (state, returns)
        state = r["from_inside"] if state == INSIDE else r["from_outside"]
    return out


def _pieces(lines: DataFrame, starts: dict[tuple[str, int], tuple[int, bool]]) -> DataFrame:
    """Records and cut records: part 0 is a whole record; of a cut one, ``opens`` tells its first piece
    and part 1 and 2 are the piece at a split's start and at its end. A file's first record is its header."""
    shared = lines.sparkSession.sparkContext.broadcast(starts)

    kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, now, state, held, whole, header, returns = shared.value, None, OUTSIDE, [], True, False, False
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [[]] * len(kinds)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in PIECES.split(", ")])

        def close() -> None:
            """The split ends inside a record."""
            if held:
                out.append((*now, 2 if whole else 1, whole, header, "\n".join(held)))

        for batch in batches:
            quoted = pa.compute.match_substring(batch.column("line"), '"').to_pylist()
            for line, file, split, some in zip(batch.column("line").to_pylist(), batch.column("file").to_pylist(), batch.column("split").to_pylist(), quoted):
                if (file, split) != now:
                    close()
                    now, held = (file, split), []
                    state, returns = starts[now]  # both passes cut the files alike
                    whole, header = state == OUTSIDE, split == 0
                    line = without_mark(line) if header else line
                held.append(line.removesuffix("\r") if returns else line)
                state = end_state(line, state) if some else state
                if state == OUTSIDE:
                    if not whole:
                        out.append((*now, 1, False, False, "\n".join(held)))
                    elif held != [""]:
                        out.append((*now, 0, True, header, "\n".join(held)))
                        header = False
                    held, whole = [], True
            yield flush()
        close()
        yield flush()

    return lines.mapInArrow(run, PIECES)


def quoted_records(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """The text of every record but the headers, in no particular order."""
    lines = _lines(spark, path, encoding)
    pieces = _pieces(lines, start_states(split_functions(lines)))
    # Cut records: each opening piece starts a new one in its file; the pieces until the next belong to it.
    in_file = Window.partitionBy("file").orderBy("split", "part")  # at most two rows a split
    cut = (pieces.where("part > 0").withColumn("n", F.sum(F.col("opens").cast("int")).over(in_file))
           .groupBy("file", "n")
           .agg(F.sort_array(F.collect_list(F.struct("split", "part", "record"))).alias("p"), F.bool_or("header").alias("header"))
           .select("header", F.array_join(F.col("p.record"), "\n").alias("record")))
    return pieces.where("part = 0").select("header", "record").unionByName(cut).where("not header").select("record")


def read_csv_quoted(spark: SparkSession, path: str, schema: T.StructType, encoding: str = "UTF-8",
                    corrupt: str | None = None) -> DataFrame:
    """CSV whose quoted fields may hold newlines, split like any other file.

    With ``corrupt`` a last column of that name holds the text of records with too few or too many fields.
    """
    fields = T.StructType([*schema.fields, *([T.StructField(corrupt, T.StringType())] if corrupt else [])])
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", **({"columnNameOfCorruptRecord": corrupt} if corrupt else {})}
    records = quoted_records(spark, path, encoding)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields.fields)
    return records.select(F.from_csv("record", F.lit(ddl), options).alias("r")).select("r.*")
