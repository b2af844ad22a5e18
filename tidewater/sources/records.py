"""Record files (S4-S8, S10): text exports of model answers, sheets and word vectors.

Line- and separator-based formats are read with Spark's splittable text
reader (custom ``lineSep``), so a large file is spread over many tasks.
``id:`` blocks are split at their marker in the same way; what a file holds
before its first marker is the first piece of the split at offset 0.
Numbered sections, whose marker varies, are cut where their lines are read; what a
task can't know to end in its part of a file is put together afterwards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.functions import text as T
from tidewater.llm.util import store


def blank_line_records(spark: SparkSession, folder: str, glob: str = "*.txt") -> DataFrame:
    """The records between blank lines, for LF, CRLF and mixed files: (file, record), line ends as "\\n".

    Several blank lines separate like one, so no record is empty. A large file is read by many tasks: records within a task's
    part of the file are whole at once; what lies before its first and after its last blank line are pieces, at most two a part, that
    are put together in file order. A record may span any number of parts.
    """
    d = spark.read.option("lineSep", "\n").option("pathGlobFilter", glob).text(folder)
    d = d.select(F.input_file_name().alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, lines, blank = None, [], False  # blank: this part has had a blank line

        def record(closed: bool):
            """What has been read since the last blank line: side null is a whole record, 0 a part's head, 1 its tail."""
            side = 1 if blank and not closed else None if blank else 0
            return (*part, side, "\n".join(lines)) if lines or side == 1 else None

        for batch in batches:
            out = []
            for file, start, line in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, start) != part:
                    if part:
                        out.append(record(False))
                    part, lines, blank = (file, start), [], False
                line = line.removesuffix("\r")
                if line:
                    lines.append(line)
                else:
                    out.append(record(True))
                    lines, blank = [], True
            yield _record_batch(out)
        if part:
            yield _record_batch([record(False)])

    cuts = d.mapInArrow(cut, "file string, start long, side int, record string")
    order = Window.partitionBy("file").orderBy("start", "side")
    pieces = cuts.where("side IS NOT NULL").withColumn("n", F.sum("side").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.array_sort(F.collect_list(F.struct("start", "side", "record")))
    text = F.array_join(F.filter(F.transform(parts, lambda p: p["record"]), lambda r: r != ""), "\n")
    joined = pieces.groupBy("file", "n").agg(text.alias("record")).where("record <> ''")
    return cuts.where("side IS NULL").select("file", "record").unionByName(joined.select("file", "record"))


def _record_batch(rows: list) -> pa.RecordBatch:
    columns = list(zip(*(r for r in rows if r))) or [()] * 4
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "start", "side", "record"])


def scan_blank_line_records(spark: SparkSession, folder: str, glob: str = "*.txt") -> DataFrame:
    """Every matching file in a folder; records separated by a blank line, LF or CRLF -> (file, record, kv map).

    Invalid UTF-8 bytes are replaced by the reader.
    """
    d = blank_line_records(spark, folder, glob).withColumn("_kv", T.key_value_entries(F.col("record")))
    return d.select("file", "record", T.last_wins_map("_kv").alias("kv"))


def marked_pieces(spark: SparkSession, path: str, marker: str) -> DataFrame:
    """The pieces between markers, without what stands before a file's first one: (file, start, pos, piece).

    A large file is read by many tasks. ``start`` is the byte at which a task's part of the file begins and ``pos``
    the piece's place in it (from 1 in the file's first part), so (start, pos) is the order in the file.
    """
    d = spark.read.option("lineSep", marker).text(path)
    d = d.select(F.input_file_name().alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("piece"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            part = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            pos = np.empty(len(part), np.int64)
            for i, own in enumerate(part):
                seen = seen + 1 if own == last else 0
                pos[i], last = seen, own
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(pos), batch.column(2)], ["file", "start", "pos", "piece"])

    return d.mapInArrow(place, "file string, start long, pos long, piece string").where("start > 0 OR pos > 0")


def scan_id_blocks(spark: SparkSession, path: str) -> DataFrame:
    """S5 (+T12, F10): split each file on the literal 'id:', drop the first piece, parse the fields; large files by many tasks."""
    pieces = marked_pieces(spark, path, "id:")
    ok = pieces.where(T.block_is_complete(F.col("piece")))
    return ok.select("file", "start", "pos", *T.extract_block_fields(F.col("piece")))


#: What is between numbered sections, and a line that starts one (its line break is the marker's white space where nothing follows the number).
SECTION_MARK = r"\n\d+\.\s+"
_NUMBERED = re.compile(r"[0-9]+\.(?:[ \t\x0b\f\r]|$)")
_WHITE = " \t\x0b\f\r"
#: Kinds of rows that a part of a file is cut into: lines before its first sure marker, whole sections, the section open at its end, sums.
HEAD, WHOLE, TAIL, SUMS = range(4)


class _SectionCutter:
    """Cuts one part of a file, line by line, at markers that are sure whatever the part before ends in.

    A marker eats the white space after it, line breaks too, so the first line with text after it is no marker. Until a line
    comes after which that is the same either way, nothing is sure. A section is kept back until the next has some text, since
    a bare number that ends the file is no marker.
    """

    def __init__(self):
        self.lines: list[str] = []  # of the open section; at first, of the head
        self.before: list[str] | None = None  # the section before, while the open one has no text
        self.sure, self.marked, self.eating = False, False, False
        self.size = self.whole = 0

    def add(self, line: str) -> tuple[int, int, str] | None:
        """(kind, place, text) of what has ended with this line, if any."""
        text = line.strip(_WHITE)
        if not self.sure:
            self.sure = bool(text) and not re.fullmatch(r"[0-9]+\.", line.rstrip(_WHITE))
            self.lines.append(line)
            return None
        out = None
        if self.eating:
            self.lines.append(line)
            if text:
                self.eating, out = False, self._close()
        elif m := _NUMBERED.match(line):
            self.before, self.lines = self.lines, [line]
            if line[m.end():].strip(_WHITE):
                out = self._close()
            else:
                self.eating = True
        else:
            self.lines.append(line)
        return out

    def _close(self) -> tuple[int, int, str]:
        ended, self.before = "\n".join(self.before), None
        if not self.marked:
            self.marked = True
            return HEAD, 0, ended
        self.whole += 1
        return WHOLE, self.whole, ended

    def end(self) -> tuple[int, int, str]:
        lines = self.lines if self.before is None else self.before + self.lines
        return TAIL if self.marked else HEAD, self.whole + 1, "\n".join(lines)


def _section_cuts(lines: DataFrame, kinds: tuple) -> DataFrame:
    """(file, start, kind, i, raw, size) of rows (file, start, line, size) in the files' order; only the given kinds have rows."""
    columns = {"file": pa.string(), "start": pa.int64(), "kind": pa.int32(), "i": pa.int64(), "raw": pa.string(), "size": pa.int64()}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, cutter = None, None

        def ended() -> list:
            return [(*part, *cutter.end(), 0), (*part, SUMS, cutter.whole, "", cutter.size)]

        def rows(found: list) -> pa.RecordBatch:
            found = [r for r in found if r[2] in kinds]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], kind) for k, kind in enumerate(columns.values())], list(columns))

        for batch in batches:
            out = []
            for file, start, line, size in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, start) != part:
                    if part:
                        out += ended()
                    part, cutter = (file, start), _SectionCutter()
                cutter.size += size + 1
                if found := cutter.add(line):
                    out.append((*part, *found, 0))
            yield rows(out)
        if part:
            yield rows(ended())

    return lines.mapInArrow(cut, "file string, start long, kind int, i long, raw string, size long")


def scan_numbered_sections(spark: SparkSession, path: str) -> DataFrame:
    """S6 (+T13): split on '\\n<number>.<spaces>', drop the first piece (so item 1 is lost at file start).

    A large file is read by many tasks (twice: for the pieces at the parts' borders, three rows a part, and for the sections inside). ``pos`` is
    the section's place in its file.
    """
    d = spark.read.option("lineSep", "\n").text(path)
    meta = F.col("_metadata")
    lines = d.select(F.input_file_name().alias("file"), meta["file_block_start"].alias("start"), F.col("value").alias("line"), F.octet_length("value").cast("long").alias("size"))
    pieces = store(_section_cuts(lines, (HEAD, TAIL, SUMS)), "section-pieces")

    sizes = d.groupBy(F.input_file_name().alias("file")).agg(F.first(meta["file_size"]).alias("bytes"))
    # each line counts as ended; the last may not be, and the reader skips a byte order mark of three bytes
    ends = pieces.groupBy("file").agg(F.sum("size").alias("size")).join(sizes, "file").select("file", (~(F.col("bytes") - F.col("size")).isin(-1, 2)).alias("ends"))
    order = Window.partitionBy("file").orderBy("start", "kind")
    texts = pieces.where(F.col("kind") != SUMS).withColumn("n", F.sum((F.col("kind") == TAIL).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.array_sort(F.collect_list(F.struct("start", "kind", "raw")))
    groups = texts.groupBy("file", "n").agg(F.min("start").alias("start"), F.array_join(F.transform(parts, lambda p: p["raw"]), "\n").alias("raw")).join(ends, "file")
    last = F.col("n") == F.max("n").over(Window.partitionBy("file"))
    raw = F.concat(F.when(F.col("n") > 0, "\n").otherwise(""), "raw", F.when(last & F.col("ends"), "\n").otherwise(""))
    groups = store(groups.withColumn("raw", raw).select("file", "n", "start", F.split("raw", SECTION_MARK).alias("_s"))
                   .select("file", "n", "start", F.slice("_s", 2, F.size("_s")).alias("sections")), "section-groups")

    tails = groups.where("n > 0").select("file", "start", F.size("sections").alias("_g"))
    heads = groups.where("n = 0").select("file", F.size("sections").alias("_g0"))
    own = pieces.where(F.col("kind") == SUMS).select("file", "start", F.col("i").alias("_w")).join(tails, ["file", "start"], "left").join(heads, "file", "left").na.fill(0, ["_g", "_g0"])
    earlier = F.coalesce(F.sum(F.col("_w") + F.col("_g")).over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = own.select("file", "start", "_w", (F.col("_g0") + earlier).alias("_at"))

    inside = _section_cuts(lines, (WHOLE,)).join(F.broadcast(own), ["file", "start"]) \
        .select("file", (F.col("_at") + F.col("i")).alias("pos"), F.split(F.concat(F.lit("\n"), "raw"), SECTION_MARK)[1].alias("section"))
    at = F.when(F.col("n") > 0, F.col("_at") + F.col("_w")).otherwise(0)
    across = groups.join(F.broadcast(own), ["file", "start"]).select("file", at.alias("_at"), F.posexplode("sections").alias("_i", "section")) \
        .select("file", (F.col("_at") + F.col("_i") + 1).alias("pos"), "section")
    sections = inside.unionByName(across)
    return sections.select("file", F.col("pos").cast("int").alias("pos"), *T.extract_section_fields(F.col("section")))


def scan_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """S7 (+T15): lines '<n>. text' -> (n int, text, label); unnumbered lines ignored."""
    d = spark.read.text(path)
    pat = r"^(\d+)\.\s*(.*)"
    m = d.where(F.col("value").rlike(pat))
    return m.select(F.regexp_extract("value", pat, 1).cast("int").alias("n"),
                    F.regexp_extract("value", pat, 2).alias("text"),
                    T.first_label(F.col("value")).alias("label"))


def scan_sheet(spark: SparkSession, path: str, index_col: bool = True) -> DataFrame:
    """Header table (CSV stand-in for a spreadsheet); the first column is the index when asked."""
    d = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return d.drop(d.columns[0]) if index_col else d


def scan_word_vectors(spark: SparkSession, path: str) -> DataFrame:
    """S10: 'token f1 ... fn' lines, no header -> (token, vector array<float>)."""
    d = spark.read.text(path).select(F.split(F.col("value"), " ").alias("p"))
    return d.select(F.col("p")[0].alias("token"),
                    F.transform(F.slice("p", 2, F.size("p") - 1), lambda x: x.cast("float")).alias("vector"))


def write_text_with_header(lines: DataFrame, path: str, header: str) -> None:
    """Write a one-column text frame so that every output file starts with ``header``.

    Saved answer files start with a preamble; writers that split output over
    many files repeat it per file (per partition), so readers that drop the
    first piece of a file stay correct.
    """
    def prepend(batches):
        first = True
        for batch in batches:
            if first:
                yield pa.RecordBatch.from_arrays([pa.array([header], batch.schema.field(0).type)], ["line"])
                first = False
            yield batch

    lines.toDF("line").mapInArrow(prepend, "line string").write.mode("overwrite").text(path)
