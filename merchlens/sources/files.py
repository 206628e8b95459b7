"""Source files: discovery, hash, and what their names say."""

from __future__ import annotations

import codecs
import csv
import hashlib
import io
import itertools
import re
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from merchlens.session import materialize

# Store codes of the monthly file names.
STORE_CODES = {"JQ": "JQ-US", "MT": "MT-US", "RKZ": "RKZ-US", "SY": "SY-US"}


def discover_files(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """Path, length and modification time of the ``*.txt`` files below ``root``, by path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    folder = system.exists(place) and system.getFileStatus(place).isDirectory()
    if not folder and re.search(r"\.[^./]+$", root) and not root.lower().endswith(".txt"):
        raise ValueError(f"not a TXT file: {root}")
    reader = spark.read.format("binaryFile")
    if folder or not root.lower().endswith(".txt"):
        reader = reader.option("pathGlobFilter", "*.txt").option("recursiveFileLookup", str(recursive).lower())
    return (
        reader.load(root)
        .select("path", "length", "modificationTime")
        .orderBy("path")
    )


def file_hashes(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Length and SHA-256 per file. A hash runs over a file in order: one task reads it, a piece at a time."""
    def of(batches):
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                system, name = (
                    (fs.LocalFileSystem(), re.sub("^file:/*", "/", path)) if re.match("file:|/", path)
                    else fs.FileSystem.from_uri(quote(path, safe=":/%@?=&"))
                )
                digest, length = hashlib.sha256(), 0
                with system.open_input_stream(name, compression=None) as stream:
                    while piece := stream.read(1 << 20):
                        digest.update(piece)
                        length += len(piece)
                rows.append((path, length, digest.hexdigest()))
            columns = [pa.array(c) for c in zip(*rows, strict=True)] if rows else [pa.array([], t) for t in (pa.string(), pa.int64(), pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["path", "length", "source_file_sha256"])

    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, min(len(paths), 1000)), "path")
    return listed.mapInArrow(of, "path string, length bigint, source_file_sha256 string")


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)$", 1)


def stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"\.[^.]*$", "")


def parent_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)


def store_from_name(path: Column, store_map: dict[str, str]) -> Column:
    """Store of the longest prefix the file stem starts with, else the parent folder; null if none."""
    prefixes = {p.strip().upper(): s.strip() for p, s in store_map.items() if p.strip() and s.strip()}
    ordered = sorted(prefixes, key=lambda p: (-len(p), p))
    matches = [
        F.when(F.startswith(F.upper(name), F.lit(p)), F.lit(prefixes[p]))
        for name in (stem(path), parent_name(path))
        for p in ordered
    ]
    return F.coalesce(*matches) if matches else F.lit(None).cast("string")


def month_from_name(path: Column) -> Column:
    """``20yy[-_]mm`` anywhere in the stem, else a free-standing ``yymm``; null if neither."""
    name = stem(path)
    # The two forms of a month in a file name.
    long_form = r"(20\d{2})[-_]?(0[1-9]|1[0-2])"
    short_form = r"(?<!\d)(\d{2})(0[1-9]|1[0-2])(?!\d)"

    def date_of(pattern: str, prefix: str) -> Column:
        year = F.nullif(F.regexp_extract(name, pattern, 1), F.lit(""))
        month = F.regexp_extract(name, pattern, 2)
        return F.when(
            year.isNotNull(),
            F.make_date(F.concat(F.lit(prefix), year).try_cast("int"), month.try_cast("int"), F.lit(1)),
        )

    return F.coalesce(date_of(long_form, ""), date_of(short_form, "20"))


# Fixed value: the form of monthly file names.
MONTHLY_NAME = r"(?i)^(JQ|MT|RKZ|SY)(\d{2})(\d{2})(?:-|$)"


def monthly_name(path: Column) -> Column:
    """Struct of store and month for names like ``RKZ2607-note.txt``; null if not of that form."""
    name = stem(path)
    code = F.upper(F.regexp_extract(name, MONTHLY_NAME, 1))
    month = F.regexp_extract(name, MONTHLY_NAME, 3).try_cast("int")
    year = F.regexp_extract(name, MONTHLY_NAME, 2).try_cast("int")
    store = F.coalesce(*[F.when(code == k, F.lit(v)) for k, v in STORE_CODES.items()])
    good = store.isNotNull() & month.between(1, 12)
    first = F.make_date(year + 2000, F.when(good, month), F.lit(1))
    return F.when(good, F.struct(store.alias("store_name"), first.alias("report_month")))


def batch_number(store: Column, month: Column, sha256: Column, stamp: str) -> Column:
    return F.concat(
        F.lit("txt_"), F.replace(store, F.lit("-"), F.lit("")), F.lit("_"),
        F.date_format(month, "yyyyMM"), F.lit(f"_{stamp}_"), F.substring(sha256, 1, 8),
    )


JAVA_CHARSETS = "spark.sql.legacy.javaCharsets"
# What is read of a file at first to find its header; more is read until the header is complete.
HEAD_BYTES = 65536


def head_bytes(spark: SparkSession, path: str, size: int = HEAD_BYTES) -> bytes:
    jvm = spark._jvm
    file = jvm.org.apache.hadoop.fs.Path(path)
    stream = file.getFileSystem(spark._jsc.hadoopConfiguration()).open(file)
    try:
        bounded = jvm.org.apache.commons.io.input.BoundedInputStream(stream, size)
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(bounded))
    finally:
        stream.close()


def read_lines(spark: SparkSession, paths: list[str] | str, charset: str, *more: Column) -> DataFrame:
    """Column ``line`` of text files, split between tasks. Bytes that do not decode fail the job.

    GB18030 is decoded from the raw bytes of each line: no part of a character
    equals a line break there.
    """
    if charset == "UTF-8":
        return spark.read.text(paths).select(F.col("value").alias("line"), *more)
    # The setting is read when the expression is built; the session is left as it was.
    before = spark.conf.get(JAVA_CHARSETS, "false")
    spark.conf.set(JAVA_CHARSETS, "true")
    try:
        decoded = F.decode(F.col("value").cast("binary"), charset)
        return spark.read.text(paths).select(decoded.alias("line"), *more)
    finally:
        spark.conf.set(JAVA_CHARSETS, before)


# Fixed value: the longest field, in characters, that a report may hold.
FIELD_LIMIT = 131072


def split_fields(line: Column, delimiter: str) -> Column:
    """What stands between delimiters, quoted or not."""
    return F.split(line, re.escape(delimiter), -1)


# Fixed value: what stands in a quoted field up to the quote that ends it.
QUOTED = '(?:[^"]++|"")*+'


def end_state(line: Column, delimiter: str, inside: bool) -> Column:
    """1 if a quoted field is open at the end of ``line``, else 0; ``inside``: one is open where the line begins.

    A quote opens a field only as its first character; elsewhere in an unquoted field it is a character. A quoted
    field ends at a quote that is not doubled, and what follows up to the delimiter belongs to the field.
    """
    mark = re.escape(delimiter)
    ended = f'"[^{mark}]*+{mark}'
    opens = f'(?:"{QUOTED}{ended}|(?!")[^{mark}]*+{mark})*+"{QUOTED}\\z'
    pattern = f"^{QUOTED}(?:\\z|{ended}{opens})" if inside else f"^{opens}"
    return F.when(F.contains(line, F.lit('"')), line.rlike(pattern).cast("int")).otherwise(int(inside))


def fields_of(record: Column, delimiter: str) -> Column:
    """The fields of a record as an array of text, quotes taken off; an open field at the end is taken as it is."""
    mark = re.escape(delimiter)
    # Each field before its delimiter: quoted, quoted and open up to the end, or plain.
    field = f'("{QUOTED}"[^{mark}]*+|"[\\s\\S]*(?={mark}\\z)|[^{mark}]*+){mark}'
    found = F.regexp_extract_all(F.concat(record, F.lit(delimiter)), F.lit(field), F.lit(1))
    quote = F.lit('"')

    def plain(part: Column) -> Column:
        rest = F.substr(part, F.lit(2))
        inner = F.regexp_extract(rest, f'^({QUOTED})"([\\s\\S]*)$', 1)
        outer = F.regexp_extract(rest, f'^({QUOTED})"([\\s\\S]*)$', 2)
        closed = rest.rlike(f'^{QUOTED}"')
        text = F.when(closed, F.concat(F.replace(inner, F.lit('""'), quote), outer)).otherwise(F.replace(rest, F.lit('""'), quote))
        return F.when(F.startswith(part, quote), text).otherwise(part)

    # A quote means something only where a field begins; without one there, the record is cut at its delimiters.
    quoted = F.startswith(record, quote) | F.contains(record, F.lit(f'{delimiter}"'))
    return F.when(quoted, F.transform(found, plain)).otherwise(split_fields(record, delimiter))


def inspect_text(spark: SparkSession, path: str) -> str:
    """Charset of a whole file: UTF-16 by its mark; UTF-8 if all of it is valid UTF-8; else GB18030 if all of it decodes so."""
    if head_bytes(spark, path, 2) in (b"\xff\xfe", b"\xfe\xff"):
        return "UTF-16"
    if spark.read.text(path).agg(F.bool_and(F.is_valid_utf8("value"))).first()[0] is not False:
        return "UTF-8"
    try:
        read_lines(spark, path, "GB18030").agg(F.max(F.length("line"))).collect()
    except Exception as error:
        if "MALFORMED_CHARACTER" not in str(error):
            raise
        raise ValueError("unknown text encoding; UTF-8, UTF-16 and GB18030 are supported") from error
    return "GB18030"


def holds_open_lines(spark: SparkSession, paths: list[str] | str, charset: str, delimiter: str) -> bool:
    """Whether a line of the files leaves a quoted field open, so that records may span lines; one pass."""
    def open_(line: Column) -> Column:
        return end_state(line, delimiter, False) == 1

    lines = read_lines(spark, paths, charset)
    marked = F.ltrim(F.col("line"), F.lit("\ufeff"))
    return not lines.filter(open_(F.col("line")) | (F.startswith(F.col("line"), F.lit("\ufeff")) & open_(marked))).isEmpty()


def header_record(spark: SparkSession, path: str, charset: str) -> tuple[list[str], str]:
    """The names in the first record of a file, however long, and its delimiter; no names if the file is blank."""
    size = HEAD_BYTES
    while True:
        head = head_bytes(spark, path, size)
        text = codecs.getincrementaldecoder(charset)(errors="strict").decode(head, final=False).lstrip("\ufeff\r\n")
        whole = len(head) < size
        line = re.match(r"[^\r\n]*", text).group()
        if whole or len(line) < len(text):
            if not line.strip():
                return [], "\t"
            delimiter = sniff_delimiter(line)
            reader = csv.reader(io.StringIO(text, newline=""), delimiter=delimiter)
            names = next(reader)
            # The record is complete if another one, or the file's end, follows it.
            if whole or next(reader, None) is not None:
                return names, delimiter
        size *= 4


def sniff_delimiter(header: str) -> str:
    """Tab if the header has one outside quotes, else the most frequent of comma, semicolon and bar there."""
    outside = "".join(header.split('"')[::2])
    if "\t" in outside:
        return "\t"
    best = max(",;|", key=outside.count)
    if best not in outside:
        raise ValueError("unknown delimiter; order reports are tab separated")
    return best


def normalize_header(name: str) -> str:
    """Lower-case column name: every run of other characters than letters, digits and CJK is one underscore."""
    return "_".join(filter(None, re.split(r"[^0-9A-Za-z一-鿿]+", name))).lower()


def number_rows(rows: DataFrame) -> DataFrame:
    """``source_row_no``: the place of each row in its file, from 1.

    ``rows`` carries ``_path``, ``_block`` and ``_place`` from the scan. Rows of
    one block keep their order in ``_place``; the count of rows in the blocks
    before gives the rest, so no file passes through one task and nothing is
    written. The counts come from a scan of the same files cut into the same
    blocks; a row that finds no count for its block fails the job. The counts are
    one row per file block, as the listing of the files is; sent to the tasks,
    they spare a shuffle of all the rows.
    """
    blocks = rows.groupBy("_path", "_block").agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    before = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "_path", "_block", "_first", "_rows", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    number = F.col("_place") - F.col("_first") + F.col("_before") + 1
    inside = (number > F.col("_before")) & (number <= F.col("_before") + F.col("_rows"))
    checked = F.when(inside, number).otherwise(F.raise_error(F.lit("file blocks changed during the read")))
    return (
        rows.join(F.broadcast(offsets), ["_path", "_block"], "left")
        .withColumn("source_row_no", checked.cast("bigint"))
        .drop("_first", "_rows", "_before", "_place", "_block")
    )


def text_lines(spark: SparkSession, paths: list[str] | str, charset: str, keep_blank: bool) -> DataFrame:
    """Numbered lines of text files, split between tasks. Column ``line``."""
    rows = read_lines(spark, paths, charset, *scan_position())
    if not keep_blank:
        rows = rows.filter(F.col("line") != "")
    numbered = number_rows(rows)
    mark = F.when(F.col("source_row_no") == 1, F.ltrim(F.col("line"), F.lit("\ufeff")))
    return numbered.withColumn("line", F.coalesce(mark, "line"))


def _line_steps():
    """Small steps over lines of file blocks. They go to the tasks by value: workers need not find this package."""
    def run_states(closed: np.ndarray, opened: np.ndarray, state: int) -> np.ndarray:
        """The state before each of some lines and after the last, where ``state`` holds before the first.

        ``closed`` and ``opened`` are the states after a line where no quoted field is open before it, and where one is.
        What holds is what the last line set that sets it either way, turned over as often as lines did after that.
        """
        sets, turned = closed == opened, np.cumsum((closed == 1) & (opened == 0))
        last = np.maximum.accumulate(np.where(sets, np.arange(len(sets)), -1))
        after = np.where(last >= 0, closed[last] + turned - turned[last], state + turned) % 2
        return np.concatenate([[state], after])

    def block_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bool, pa.RecordBatch]]:
        """Runs of lines of one file block: path, block, whether the block begins with the run, the lines."""
        last = None
        for batch in batches:
            paths, blocks = batch.column("_path").dictionary_encode(), batch.column("_block").to_numpy(zero_copy_only=False)
            codes = paths.indices.to_numpy(zero_copy_only=False)
            if not len(blocks):
                continue
            cuts = [0, *(np.flatnonzero((np.diff(codes) != 0) | (np.diff(blocks) != 0)) + 1).tolist(), len(blocks)]
            for start, end in itertools.pairwise(cuts):
                at = (paths.dictionary[int(codes[start])].as_py(), int(blocks[start]))
                yield *at, at != last, batch.slice(start, end - start)
                last = at

    def marks(run: pa.RecordBatch, first: bool) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The lines of a run without the mark of its file, and the states after them."""
        lines, closed, opened = (run.column(n) for n in ("line", "_closed", "_opened"))
        closed, opened = closed.to_numpy(zero_copy_only=False).astype(np.int64), opened.to_numpy(zero_copy_only=False).astype(np.int64)
        bare = run.column("_bare")[0]
        if first and bare["line"].is_valid:
            lines = pa.concat_arrays([pa.array([bare["line"].as_py()], lines.type), lines.slice(1)])
            closed[0], opened[0] = bare["closed"].as_py(), bare["opened"].as_py()
        return lines, closed, opened

    def starts(lines: pa.Array, before: np.ndarray, keep_blank: bool) -> np.ndarray:
        """Whether a record begins at each line."""
        begins = before == 0
        return begins if keep_blank else begins & (pc.binary_length(lines).to_numpy(zero_copy_only=False) > 0)

    return run_states, block_runs, marks, starts


def _block_maps(keep_blank: bool):
    """Per file block: the state after it and the records it begins, for either state before it."""
    run_states, block_runs, marks, starts = _line_steps()

    def of(batches):
        at, state, begun = None, [0, 1], [0, 0]
        schema = pa.schema([("_path", pa.string()), *[(n, pa.int64()) for n in ("_block", "_after0", "_after1", "_begun0", "_begun1")]])

        def row():
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*at, *state, *begun)], schema=schema)

        for path, block, new, run in block_runs(batches):
            if new:
                if at:
                    yield row()
                at, state, begun = (path, block), [0, 1], [0, 0]
            lines, closed, opened = marks(run, new and block == 0)
            for s in (0, 1):
                run_of = run_states(closed, opened, state[s])
                begun[s] += int(starts(lines, run_of[:-1], keep_blank).sum())
                state[s] = int(run_of[-1])
        if at:
            yield row()

    return of


def _block_records(known: dict[tuple[str, int], tuple[int, int]], keep_blank: bool, most: int):
    """Numbered records. Those that lie in one block come whole; of others the piece in each block, with the block."""
    run_states, block_runs, marks, starts = _line_steps()

    def checked(number, text):
        if len(text) >= most and len(text.decode(errors="replace")) >= most:
            raise ValueError(f"a field is longer than allowed in the record of row {number}")

    def of(batches):
        schema = pa.schema([("_path", pa.string()), ("source_row_no", pa.int64()), ("_piece", pa.int64()), ("line", pa.binary())])
        at, state, number, open_, borders = None, 0, 0, [], False

        def waiting(ended):
            # The lines that wait: a record, or the piece of one that began in another block or goes on in one.
            text = b"\n".join(open_)
            checked(number, text)
            values = (at[0], number, None if ended and not borders else at[1], text)
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(values, schema, strict=True)], schema=schema)

        for path, block, new, run in block_runs(batches):
            if new:
                if open_:
                    yield waiting(state == 0)
                at, open_ = (path, block), []
                if at not in known:
                    raise ValueError("file blocks changed during the read")
                state, number = known[at]
                borders = state == 1
            lines, closed, opened = marks(run, new and block == 0)
            before = run_states(closed, opened, state)
            state, begins = int(before[-1]), before[:-1] == 0
            places = np.flatnonzero(begins)
            head = int(places[0]) if len(places) else len(lines)
            if head:
                open_.extend(lines.slice(0, head).to_pylist())
                if sum(map(len, open_)) >= most:
                    checked(number, b"\n".join(open_))
            if not len(places):
                continue
            if open_:
                yield waiting(True)
            open_, borders = [], False
            ends = np.append(places[1:], len(lines))
            if state == 1:
                # The last record is still open; its lines wait for the rest.
                tail = int(places[-1])
                places, ends = places[:-1], ends[:-1]
            if len(places):
                cuts = pa.array(np.append(places, ends[-1]) - head, pa.int32())
                records = pc.binary_join(pa.ListArray.from_arrays(cuts, lines.slice(head, int(ends[-1]) - head)), b"\n")
                several = ends - places > 1
                if not keep_blank:
                    # A blank line where no field is open is no record.
                    begun = starts(lines, before[:-1], False)[places]
                    records, several = records.filter(pa.array(begun)), several[begun]
                numbers = number + 1 + np.arange(len(records))
                number += len(records)
                sizes = pc.binary_length(records).to_numpy(zero_copy_only=False)
                for i in np.flatnonzero(several & (sizes >= most)).tolist():
                    checked(int(numbers[i]), records[i].as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(path), len(records)), pa.array(numbers, pa.int64()), pa.nulls(len(records), pa.int64()), records], schema=schema)
            if state == 1:
                open_, number = lines.slice(tail).to_pylist(), number + 1
        if open_:
            yield waiting(state == 0)

    return of


def text_records(
    spark: SparkSession, paths: list[str] | str, charset: str, delimiter: str, keep_blank: bool, width: int
) -> DataFrame:
    """Numbered records whose quoted fields may hold line breaks, split between tasks. Column ``line``.

    A line maps the state before it (a quoted field is open, or none is) to the state after it. There are four such
    maps: two set the state, one turns it over, one keeps it. A run of lines is a map again, and so is a block of a
    file. A first pass gives the map of each block and the records it begins for either state; the table of blocks, a
    row per file block as the listing of the files has, says which state holds before each. A second pass then reads
    each block with that state: its records are put together where they are read, a batch at a time, and stored once; no
    line is sorted or shuffled. Only of records that lie across blocks, one at each border at most, the pieces meet.

    A record longer than ``width`` fields of the largest size fails the job before its lines are put together.
    """
    mark = F.lit("\ufeff")
    rows = read_lines(spark, paths, charset, *scan_position()[:2])
    bare = F.ltrim(F.col("line"), mark)

    def mapped(line: Column) -> list[Column]:
        return [end_state(line, delimiter, inside) for inside in (False, True)]

    closed, opened = mapped(F.col("line"))
    bare_closed, bare_opened = mapped(bare)
    marked = (F.col("_block") == 0) & F.startswith(F.col("line"), mark)
    # As bytes, which need not be valid text.
    rows = rows.select(
        "_path", "_block", F.col("line").cast("binary").alias("line"), closed.alias("_closed"), opened.alias("_opened"),
        F.when(marked, F.struct(bare.cast("binary").alias("line"), bare_closed.alias("closed"), bare_opened.alias("opened"))).alias("_bare"),
    )
    blocks = rows.mapInArrow(
        _block_maps(keep_blank), "_path string, _block bigint, _after0 bigint, _after1 bigint, _begun0 bigint, _begun1 bigint"
    ).collect()
    known, across = {}, False
    for path, of_path in itertools.groupby(sorted(blocks), key=lambda b: b["_path"]):
        state, ahead = 0, 0
        for block in of_path:
            known[path, block["_block"]] = (state, ahead)
            ahead += block[f"_begun{state}"]
            state = block[f"_after{state}"]
            across |= state == 1
    most = width * (FIELD_LIMIT + 1)
    records = materialize(rows.mapInArrow(
        _block_records(known, keep_blank, most), "_path string, source_row_no bigint, _piece bigint, line binary"
    ).withColumn("line", F.col("line").cast("string")), "text-records", "zstd")
    whole = records.filter("_piece IS NULL").select("_path", "source_row_no", "line")
    if not across:
        return whole
    size = F.sum(F.length("line") + F.lit(1)).over(Window.partitionBy("_path", "source_row_no"))
    too_long = F.raise_error(F.concat(F.lit("a field is longer than allowed in the record of row "), F.col("source_row_no")))
    pieces = records.filter("_piece IS NOT NULL").withColumn("line", F.when(size > most, too_long).otherwise(F.col("line")))
    ordered = F.array_sort(F.collect_list(F.struct("_piece", "line")))
    joined = pieces.groupBy("_path", "source_row_no").agg(
        F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("line")
    )
    return whole.unionByName(joined)


def scan_position() -> list[Column]:
    # The scan gives paths percent-encoded, a file listing as they are.
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return [
        F.url_decode(encoded).alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_place"),
    ]
