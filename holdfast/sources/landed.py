"""Readers and writers of landed files. Schemas are explicit, so that codes keep their leading zeros."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import csv
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.functions import scalars as S
from holdfast.operators import stages

HOLDINGS = "fund_isin string, constituent_isin string, constituent_name string, weight double, as_of date, source_quantity double, source_currency string, source_market_value double, weight_source string, identifier_method string, published_at timestamp, source_document_id string, source_url string, evidence_basis string, source_row_id string"
CROSSWALK = "entity_kind string, local_key_type string, local_key string, local_name string, standard_id_type string, standard_id string, standard_name string, source_url string, reviewed_by string, reviewed_at string"
MANIFEST = "run_id string, source string, phase string, window_date date, batch_id string, status string, document_id string, target string, sha256 string, n_records long, published_at timestamp, message string"
POSITION = "name: string, title: string, cusip: string, balance: string, units: string, curCd: string, valUSD: string, pctVal: string, isin: string, identifiers: struct<isin: struct<_value: string>>, currencyConditional: struct<_curCd: string>"
FILING = f"formData struct<genInfo: struct<reportDate: string, periodOfReport: string, repPdDate: string>, fundInfo: struct<invstOrSecs: struct<invstOrSec: array<struct<{POSITION}>>>>>"

# Headers of baskets, as they are compared, and what they mean
BASKET_HEADERS = {
    "기준일": "as_of", "기준일자": "as_of", "asof": "as_of", "date": "as_of",
    "종목명": "name", "name": "name",
    "표준코드": "source_isin", "isin": "source_isin",
    "종목코드": "krx_code", "code": "krx_code",
    "비중(%)": "weight_pct", "비중": "weight_pct", "weight": "weight_pct",
    "수량": "quantity", "quantity": "quantity",
    "평가금액": "market_value", "marketvalue": "market_value",
    "통화": "currency", "currency": "currency",
}
BASKET = ["as_of", "name", "source_isin", "krx_code", "weight_pct", "quantity", "market_value", "currency"]


def holdings_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=HOLDINGS, header=True, enforceSchema=False)


def crosswalk_csv(spark: SparkSession, path: str) -> DataFrame:
    """The header must be the ten columns in order."""
    return spark.read.csv(path, schema=CROSSWALK, header=True, enforceSchema=False)


def manifest_json(spark: SparkSession, path: str) -> DataFrame:
    """Fields that older lines lack are null."""
    return spark.read.schema(MANIFEST).json(path)


# Fixed values
CROSSWALK_REQUIRED = ["entity_kind", "local_key_type", "local_key", "standard_id_type", "standard_id"]


def crosswalk_problems(rows: DataFrame) -> DataFrame:
    """The rows that lack a required field, with the first one's name; a crosswalk with any is not taken in."""
    problem = F.coalesce(*[F.when(S.text(F.col(k)).isNull(), F.lit(f"missing required field: {k}")) for k in CROSSWALK_REQUIRED])
    return rows.withColumn("problem", problem).where("problem is not null")


def target_lists(lists: DataFrame, value: str, keys: list[str], identity: list[str], sources: list[str]) -> DataFrame:
    """Adds source, targets (maps) and problem to lists of targets, ``{"source": ..., "targets": [...]}`` in column ``value``.

    A list is sound if it has exactly these two members, a known source, and targets of exactly ``keys`` no two of which
    have one ``identity``.
    """
    own = F.array_sort(F.json_object_keys(F.col(value)))
    parsed = F.from_json(value, "source string, targets array<map<string,string>>")
    exact = F.array(*map(F.lit, sorted(keys)))
    ids = F.transform("targets", lambda x: F.concat_ws("\x00", *[x[k] for k in identity]))
    out = lists.withColumn("_own", own).withColumn("_list", parsed).withColumn("source", F.col("_list.source")).withColumn("targets", F.col("_list.targets"))
    checks = [
        (F.col("_own").isNull(), "not an object"), (F.col("_own") != F.array(F.lit("source"), F.lit("targets")), "unexpected or missing keys"),
        (F.col("source").isNull() | ~F.col("source").isin(sources), "unknown source"), (F.col("targets").isNull(), "targets are not a list"),
        (F.exists("targets", lambda x: F.array_sort(F.map_keys(x)) != exact), "a target has unexpected or missing keys"),
        (F.size(F.array_distinct(ids)) < F.size("targets"), "duplicate document"),
    ]
    return out.withColumn("problem", F.coalesce(*[F.when(c, F.lit(r)) for c, r in checks])).drop("_own", "_list")


def targets_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The targets of one list file, one row each; ``schema`` is that of a target."""
    return spark.read.schema(f"targets array<struct<{schema}>>").json(path, multiLine=True).select(F.explode("targets").alias("t")).select("t.*")


def strict_json(lines: DataFrame, value: str, schema: str, keys: list[str]) -> DataFrame:
    """Adds record (parsed) and problem: lines that aren't JSON objects of exactly these keys have one."""
    own = F.array_sort(F.json_object_keys(F.col(value)))
    problem = F.when(own.isNull(), "not an object").when(own != F.array(*map(F.lit, sorted(keys))), "unexpected or missing keys")
    return lines.withColumn("record", F.from_json(value, schema)).withColumn("problem", problem)


#: A cell at the place at hand, in quotes if it begins with one; and a record, which ends at a line break outside quotes.
_CELL = r'(?:"[^"]*+(?:""[^"]*+)*+(?:"[^,\r\n]*+|\z)|[^,\r\n"][^,\r\n]*+|)'
_RECORD = f"{_CELL}(?:,{_CELL})*+"


#: The same in bytes of any encoding that leaves ASCII's to themselves: whole records with their ends.
_SHUT = rb'(?:"[^"]*+(?:""[^"]*+)*+"[^,\r\n]*+|[^,\r\n"][^,\r\n]*+|)'
_ONE = re.compile(rb"%s(?:,%s)*+[\r\n]" % (_SHUT, _SHUT))
_WHOLE = re.compile(rb"(?:%s(?:,%s)*+[\r\n])*+" % (_SHUT, _SHUT))
_MARK = b"\xef\xbb\xbf"
#: The same of records whose quotes have nothing after them in their cells, which other readers take alike.
_PLAIN = rb'(?:"[^"]*+(?:""[^"]*+)*+"|[^,\r\n"][^,\r\n]*+|)'
_REGULAR = re.compile(rb"(?:%s(?:,%s)*+[\r\n])*+" % (_PLAIN, _PLAIN))
_RECORDS, _CELLS = (re.compile(x.replace(r"\z", r"\Z")) for x in (_RECORD, f",({_CELL})"))


def _basket_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, block, line): lines in the splits that they are read in, as they are in the files."""
    return spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))


def _document(path: str) -> Column:
    """A file's address as documents are named by."""
    return F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")


def _runs(batches):
    """Of batches in reading order: (row that tells the split, the split's next lines with their ends)."""
    for batch in batches:
        names, blocks, lines = (batch.column(c) for c in ("path", "block", "line"))
        n = batch.num_rows
        if not n:
            continue
        other = pc.or_(pc.not_equal(names[1:], names[:-1]), pc.not_equal(blocks[1:], blocks[:-1])).to_numpy(zero_copy_only=False)
        at = [0, *(other.nonzero()[0] + 1).tolist(), n]
        told = batch.drop_columns(["line"])
        for i, j in zip(at, at[1:]):
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), lines[i:j]), b"\n")
            yield told.slice(i, 1).to_pylist()[0], joined[0].as_py() + b"\n"


def _decodes(data: bytes, encoding: str) -> bool:
    try:
        data.decode(encoding)
    except UnicodeDecodeError:
        return False
    return True


def _ends_inside(data: bytes, inside: bool) -> bool:
    """Whether lines end inside quotes, if they begin inside or outside."""
    if b'"' not in data:
        return inside
    data = b'"' + data if inside else data
    return _WHOLE.match(data).end() < len(data)


def _filled(text: str) -> Iterator[list[str]]:
    """The records of a text of whole ones as lists of cells, blank ones left out."""

    def unquoted(c):
        if not c.startswith('"'):
            return c
        own, shut, _ = c[1:].rpartition('"')
        return (own if shut else c[1:]).replace('""', '"')

    for record in _RECORDS.finditer(text):
        cells = [unquoted(c) for c in _CELLS.findall("," + record.group())]
        if any(c.strip() for c in cells):
            yield cells


def _basket_states(fallback: str):
    """Of each split: whether it ends inside quotes if it begins outside (out0) or inside (out1), and what encodings fit.

    Of a file's first split also its first record that isn't blank, in either encoding (head8, other_head), if it ends there.
    """

    def run(batches):
        key, state, pend, heads = None, None, b"", {}
        for row, data in _runs(batches):
            if (own := (row["path"], row["block"])) != key:
                if key is not None:
                    yield pa.RecordBatch.from_pylist([state], schema)
                key, state = own, {"path": own[0], "block": own[1], "out0": False, "out1": True, "utf8": True, "other": True, "head8": None, "other_head": None}
                pend, heads = b"", {"head8": "utf-8"} if own[1] == 0 else {}
                if own[1] == 0 and data.startswith(_MARK):
                    data = data.removeprefix(_MARK)
                elif own[1] == 0:
                    heads["other_head"] = fallback
            o0 = _ends_inside(data, state["out0"])
            state |= {"out1": o0 if state["out0"] == state["out1"] else _ends_inside(data, state["out1"]), "out0": o0}
            if not data.isascii():
                state["utf8"] = state["utf8"] and _decodes(data, "utf-8")
                state["other"] = state["other"] and _decodes(data, fallback)
            if heads:
                pend += data
                if end := _WHOLE.match(pend).end():
                    for name, encoding in list(heads.items()):
                        if _decodes(pend[:end], encoding) and (first := next(_filled(pend[:end].decode(encoding)), None)):
                            state[name] = first
                            heads.pop(name)
                    pend = pend[end:]
        if key is not None:
            yield pa.RecordBatch.from_pylist([state], schema)

    schema = pa.schema([("path", pa.string()), ("block", pa.int64()), *[(n, pa.bool_()) for n in ("out0", "out1", "utf8", "other")], *[(n, pa.list_(pa.string())) for n in ("head8", "other_head")]])
    return run


def _parsed(data: bytes, n_cells: int) -> list[pa.Array] | None:
    """The columns of regular records by Arrow's reader, or none where they aren't of so many cells each."""
    reading = csv.ReadOptions(autogenerate_column_names=True, use_threads=False, block_size=len(data) + 1)
    kinds = csv.ConvertOptions(column_types={f"f{i}": pa.string() for i in range(n_cells)})
    try:
        found = csv.read_csv(pa.BufferReader(data), reading, csv.ParseOptions(newlines_in_values=True), kinds).combine_chunks()
    except pa.ArrowInvalid:
        return None
    return [c.chunk(0) for c in found.columns] if found.num_columns == n_cells and found.num_rows else None


def _basket_rows(fallback: str):
    """Of files none of whose splits begins or ends inside quotes: rows below the header, in the eight columns, without white space at their ends.

    Regular records of as many cells as the header are parsed by Arrow's reader, others one by one. ``k`` numbers a split's rows.
    """

    def columns(data, regular, row):
        encoding = "utf-8" if row["utf8"] else fallback
        places = [int(x) for x in row["places"].split(",")]
        known = [x for x in places if x >= 0]
        found = _parsed(data if row["utf8"] or data.isascii() else data.decode(encoding).encode(), row["n_cells"]) if regular else None
        if found is None:
            rows = list(_filled(data.decode(encoding)))
            own = {x: pc.utf8_trim(pa.array([r[x] if x < len(r) else None for r in rows], pa.string()), S._BLANKS) for x in known}
            filled, n = None, len(rows)
        else:
            own = {x: pc.utf8_trim(found[x], S._BLANKS) for x in known}
            filled, n = pc.not_equal(own[known[0]], ""), len(found[0])
            # a row of blank cells alone is left out
            for x in range(row["n_cells"]) if not pc.all(filled).as_py() else []:
                filled = pc.or_(filled, pc.not_equal(pc.utf8_trim(found[x], S._BLANKS), ""))
            own = {x: c.filter(filled) for x, c in own.items()} if not pc.all(filled).as_py() else own
            n = len(own[known[0]])
        return [pc.if_else(pc.equal(own[x], ""), None, own[x]) if x >= 0 else pa.nulls(n, pa.string()) for x in places]

    def run(batches):
        key, n, pend, header = None, 0, [], False
        for row, data in _runs(batches):
            if (own := (row["d"], row["block"])) != key:
                key, n, pend, header = own, 0, [], own[1] == 0
                data = data.removeprefix(_MARK) if own[1] == 0 and row["utf8"] else data
            # what is pending is inside quotes, so lines without any go on with it
            if pend and b'"' not in data:
                pend.append(data)
                continue
            data = b"".join([*pend, data]) if pend else data
            regular = _REGULAR.match(data).end() == len(data)
            end = len(data) if regular else _WHOLE.match(data).end()
            pend = [data[end:]] if end < len(data) else []
            if not end:
                continue
            found = columns(data[:end] if pend else data, regular, row)
            if header and len(found[0]):
                found, header = [c[1:] for c in found], False
            if size := len(found[0]):
                at = [pa.repeat(pa.scalar(x, pa.int64()), size) for x in own]
                yield pa.RecordBatch.from_arrays([*at, pa.array(np.arange(n, n + size)), *found], schema=schema)
                n += size

    schema = pa.schema([*[(x, pa.int64()) for x in ("d", "block", "k")], *[(x, pa.string()) for x in BASKET]])
    return run


def _basket_pieces(fallback: str):
    """Of each split: texts of whole records, some thousand lines each (whole), and what it has of records that lie over its ends (tail, head).

    ``early``: no piece of the split before it surely has a record that isn't blank.
    """

    def run(batches):
        key, n, pend, skip, early, row = None, 0, [], False, True, {}

        def piece(kind, data):
            nonlocal n, early
            n += 1
            value = data.decode("utf-8" if row["utf8"] else fallback)
            out = {"document": row["document"], "block": row["block"], "i": n, "kind": kind, "early": early or kind != "whole", "value": value}
            early = early and not re.search(r"\w", value)
            return pa.RecordBatch.from_pylist([out], schema)

        for next_row, data in _runs(batches):
            if (own := (next_row["document"], next_row["block"])) != key:
                if pend:
                    yield piece("head", b"".join(pend))
                key, n, pend, skip, early, row = own, 0, [], next_row["inside"], True, next_row
                data = data.removeprefix(_MARK) if own[1] == 0 and row["utf8"] else data
            if skip:
                ended = _ONE.match(b'"' + data) if b'"' in data else None
                yield piece("tail", data[: ended.end() - 1] if ended else data)
                if ended is None:
                    continue
                skip, data = False, data[ended.end() - 1 :]
            # what is pending is inside quotes, so lines without any go on with it
            if pend and b'"' not in data:
                pend.append(data)
                continue
            data = b"".join([*pend, data])
            end = _WHOLE.match(data).end()
            pend = [data[end:]] if end < len(data) else []
            if end:
                yield piece("whole", data[:end])
        if pend:
            yield piece("head", b"".join(pend))

    schema = pa.schema([("document", pa.string()), ("block", pa.int64()), ("i", pa.int64()), ("kind", pa.string()), ("early", pa.bool_()), ("value", pa.string())])
    return run


def _baskets(spark: SparkSession, path: str, fallback: str) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(documents (d, path, document, utf8, header, places, plain, first, problem), lines, units (document, at, rows) of those that aren't plain).

    Files are read by lines in splits, so that a task's memory doesn't grow with them. One reading tells of each split whether
    it ends inside quotes, from which follows how the next one begins, and of each file its header. Where no split begins or ends inside
    quotes, files are plain. For others, if any, records are made in the splits, and only those over
    an end of a split are put together by a shuffle. Splits and files have a small row each, as in Spark's own listing of them.
    """
    if '",\r\n'.encode(fallback) != b'",\r\n':
        raise ValueError(f"{fallback} doesn't leave ASCII to itself")
    lines = _basket_lines(spark, path)
    read = lines.mapInArrow(_basket_states(fallback), "path string, block long, out0 boolean, out1 boolean, utf8 boolean, other boolean, head8 array<string>, other_head array<string>")
    splits = F.sort_array(F.collect_list(F.struct("block", "out0", "out1")))
    head = lambda c: F.first(c, ignorenulls=True).alias(c)
    states = read.groupBy("path").agg(splits.alias("s"), F.min("utf8").alias("utf8"), F.min("other").alias("other"), head("head8"), head("other_head"))
    header = F.when(F.col("utf8"), F.col("head8")).when(F.col("other"), F.col("other_head"))
    plain = header.isNotNull() & ~F.exists("s", lambda x: x.out0)
    states = stages.written(states.select(F.monotonically_increasing_id().alias("d"), "path", _document("path").alias("document"), "s", "utf8", "other", header.alias("cells"), plain.alias("plain")), "basket-states")
    docs, units = states.select("d", "path", "document", "utf8", "plain", F.when(F.col("plain"), F.col("cells")).alias("cells"), F.when(~F.col("utf8") & ~F.col("other"), f"neither UTF-8 nor {fallback}").alias("problem")), None
    odd = states.where("not plain and (utf8 or other)")
    if odd.isEmpty():
        docs = docs.withColumn("first", F.lit(None).cast("struct<block: long, i: long>"))
    else:
        units = _units(lines, odd, fallback)
        first = units.where("early and size(rows) > 0").groupBy("document").agg(F.min("at").alias("first"), F.min_by(F.get("rows", F.lit(0)), "at").alias("found"))
        docs = docs.join(first, "document", "left").withColumn("cells", F.coalesce("cells", "found")).drop("found")
    names = F.create_map(*[F.lit(x) for kv in BASKET_HEADERS.items() for x in kv])
    docs = docs.withColumn("n_cells", F.size("cells")).withColumn("header", F.transform("cells", lambda c: names[S.header_key(c)])).drop("cells")
    # the first column of each meaning, by its number from 0, or -1
    docs = docs.withColumn("places", F.concat_ws(",", *[F.array_position("header", n) - 1 for n in BASKET]))
    has = lambda *names: F.arrays_overlap(F.array_compact("header"), F.array(*map(F.lit, names)))
    checks = [(F.col("header").isNull(), "no header row"), (~has("name"), "no column of names"), (~has("source_isin", "krx_code"), "neither a column of ISINs nor of codes")]
    docs = docs.withColumn("problem", F.coalesce("problem", *[F.when(c, F.lit(r)) for c, r in checks]))
    return stages.written(docs, "basket-documents"), lines, units


def _units(lines: DataFrame, states: DataFrame, fallback: str) -> DataFrame:
    """(document, at, early, rows): records as lists of cells, blank ones left out, of files whose records may lie over ends of splits."""
    inside = lambda i: F.aggregate(F.slice("s", F.lit(1), i), F.lit(False), lambda was, x: F.when(was, x.out1).otherwise(x.out0))
    begins = states.select("path", "document", "utf8", F.explode(F.transform("s", lambda x, i: F.struct(x.block.alias("block"), inside(i).alias("inside")))).alias("b")).select("path", "document", "b.*", "utf8")
    pieces = lines.join(F.broadcast(begins), ["path", "block"]).mapInArrow(_basket_pieces(fallback), "document string, block long, i long, kind string, early boolean, value string")
    order = Window.partitionBy("document").orderBy("block", "i")
    over = pieces.where("kind <> 'whole'").withColumn("unit", F.count(F.when(F.col("kind") == "head", 1)).over(order)).groupBy("document", "unit").agg(F.sort_array(F.collect_list(F.struct("block", "i", "value"))).alias("p"))
    over = over.select("document", F.struct(F.col("p")[0].block.alias("block"), F.col("p")[0].i.alias("i")).alias("at"), F.lit(True).alias("early"), F.array_join("p.value", "").alias("value"))
    texts = pieces.where("kind = 'whole'").select("document", F.struct("block", "i").alias("at"), "early", "value").unionByName(over)
    unquoted = lambda c: F.when(F.startswith(c, F.lit('"')), F.replace(F.regexp_replace(c, r'^"|"[^"]*$', ""), F.lit('""'), F.lit('"'))).otherwise(c)
    cells = lambda record: F.transform(F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(f",({_CELL})"), F.lit(1)), unquoted)
    rows = F.filter(F.transform(F.regexp_extract_all("value", F.lit(_RECORD), F.lit(0)), cells), lambda r: F.exists(r, lambda c: S.text(c).isNotNull()))
    return texts.select("document", "at", "early", rows.alias("rows"))


def basket_problems(spark: SparkSession, path: str, fallback: str = "cp949") -> DataFrame:
    """(document, problem): the baskets that ``basket_csv`` refuses."""
    return _baskets(spark, path, fallback)[0].where("problem is not null").select("document", "problem")


def basket_csv(spark: SparkSession, path: str, fallback: str = "cp949") -> DataFrame:
    """(document, row_number, the eight columns as text) of baskets under any known headers; others are left out.

    Files of different headers and encodings may lie together: each is UTF-8 or else in the ``fallback`` encoding. Cells in
    quotes may hold commas, quotes and line breaks. A large file is several tasks' work. Row numbers start at 2, over rows that aren't blank. Refused files (see
    ``basket_problems``) have no rows.
    """
    docs, lines, units = _baskets(spark, path, fallback)
    docs = docs.where("problem is null")
    plain = docs.where("plain")
    read = lines.join(F.broadcast(plain.select("path", "d", "utf8", "n_cells", "places")), "path").mapInArrow(_basket_rows(fallback), f"d long, block long, k long, {', '.join(f'{n} string' for n in BASKET)}")
    number = F.row_number().over(Window.partitionBy("d").orderBy("block", "k")) + 1
    out = read.withColumn("row_number", number).join(F.broadcast(plain.select("d", "document")), "d").select("document", "row_number", *BASKET)
    if units is None:
        return out
    before = F.coalesce(F.sum(F.size("rows")).over(Window.partitionBy("document").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    data = units.withColumn("before", before).join(F.broadcast(docs.where("not plain").select("document", "header", "first")), "document").select("document", "header", "first", "at", "before", F.posexplode("rows").alias("i", "cells")).where("i > 0 or at > first")
    cell = lambda name: S.text(F.when(F.array_position("header", name) > 0, F.get("cells", (F.array_position("header", name) - 1).cast("int")))).alias(name)
    return out.unionByName(data.select("document", (F.col("before") + F.col("i") + 1).cast("int").alias("row_number"), *[cell(n) for n in BASKET]))


def artifacts(spark: SparkSession, root: str, stated: dict[str, str], large: int = 1 << 27, piece: int = 1 << 23) -> DataFrame:
    """(path, sha256, size, n_records, and the fields that ``stated`` names with their types) of the files of JSON lines below ``root``.

    Lines that aren't blank are records. A field is what all records of a file say, or null where they differ or any lacks
    it. Lines are read in splits, so a large file is several tasks' work. A digest needs its whole file: files up to ``large``
    bytes are digested as they are read, larger ones by one task each in pieces of ``piece`` bytes, in bounded memory.
    """
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    small = read.load(root).where(F.col("length") <= large).select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))
    names = read.load(root).where(F.col("length") > large).select("path", F.col("length").alias("size"))

    def digest(batches):
        from pyarrow import fs

        for batch in batches:
            found = []
            for path in batch.column("path").to_pylist():
                where, name = fs.FileSystem.from_uri(quote(path.replace(":/", ":///", 1) if path.startswith("file:/") and "://" not in path else path, safe=":/@"))
                sha = hashlib.sha256()
                with where.open_input_stream(name, buffer_size=piece) as stream:
                    while data := stream.read(piece):
                        sha.update(data)
                found.append(sha.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(found, pa.string()), batch.column("size")], ["path", "sha256", "size"])

    digests = small.unionByName(names.repartition("path").mapInArrow(digest, "path string, sha256 string, size long"))
    lines = spark.read.option("recursiveFileLookup", True).text(root).select(F.col("_metadata.file_path").alias("path"), "value").where(S.text(F.col("value")).isNotNull())
    record = F.from_json("value", ", ".join(f"{k} {t}" for k, t in stated.items()))
    # a line's file is given as a URL, a file's path as it is
    lines = lines.select(_plain_path(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))).alias("_path"), record.alias("r"))
    same = [F.when((F.min(f"r.{k}") == F.max(f"r.{k}")) & (F.count(f"r.{k}") == F.count("*")), F.min(f"r.{k}")).alias(k) for k in stated]
    counts = lines.groupBy("_path").agg(F.count("*").alias("n_records"), *same)
    out = digests.withColumn("_path", _plain_path(F.col("path"))).join(counts, "_path", "left")
    return out.select("path", "sha256", "size", F.coalesce("n_records", F.lit(0)).alias("n_records"), *stated)


def _plain_path(c: Column) -> Column:
    """A file's address however many slashes follow its scheme."""
    return F.regexp_replace(c, "^([a-z0-9]+:)/+", "$1/")


def filings_xml(spark: SparkSession, path: str) -> DataFrame:
    """(document, position, report_date, name, cusip, isin, balance, value, percent, currency): every position, all text."""
    docs = spark.read.format("xml").option("rowTag", "edgarSubmission").option("ignoreNamespace", True).schema(FILING).load(path)
    docs = docs.select(F.col("_metadata.file_path").alias("document"), F.col("formData.genInfo").alias("g"), F.posexplode_outer("formData.fundInfo.invstOrSecs.invstOrSec").alias("position", "p"))
    day = F.coalesce("g.reportDate", "g.periodOfReport", "g.repPdDate")
    return docs.select("document", "position", S.parsed_date(day).alias("report_date"), S.text(F.coalesce("p.name", "p.title")).alias("name"), S.usable_identifier(F.col("p.cusip")).alias("cusip"), S.usable_identifier(F.coalesce("p.isin", "p.identifiers.isin._value")).alias("isin"), S.text(F.col("p.balance")).alias("balance"), S.text(F.col("p.valUSD")).alias("value"), S.text(F.col("p.pctVal")).alias("percent"), S.text(F.coalesce("p.curCd", "p.currencyConditional._curCd")).alias("currency"))


def field_definitions(rows: DataFrame) -> DataFrame:
    """(dataset, field, ordinal, key_role, type, local_name, example); blank names are skipped but counted."""
    return rows.where(S.text(F.col("field")).isNotNull()).select("dataset", S.text(F.col("field")).alias("field"), F.col("row_number").alias("ordinal"), "key_role", "type", "local_name", "example")


# The cell that begins the header of a sheet of field definitions, and the cells after a field's name
FIELD_HEADER = "컬럼명"
FIELD_CELLS = ["key_role", "type", "local_name", "example"]


def field_sheets(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(definitions as of ``field_definitions``, problems) of sheets' rows (dataset, row_number, cells).

    A sheet's first row that begins with the header's cell is its header; ordinals count from there, over blank names too. Sheets
    without one are refused.
    """
    cell = lambda i: S.text(F.get("cells", F.lit(i)))
    header = rows.groupBy("dataset").agg(F.min(F.when(cell(0) == FIELD_HEADER, F.col("row_number"))).alias("_header"))
    below = rows.join(header, "dataset").where("row_number > _header")
    below = below.select("dataset", cell(0).alias("field"), (F.col("row_number") - F.col("_header")).alias("row_number"), *[cell(i + 1).alias(n) for i, n in enumerate(FIELD_CELLS)])
    return field_definitions(below), header.where("_header is null").select("dataset", F.lit("no schema header").alias("problem"))


def refused_feeds(files: DataFrame, feed: str, name: str, baseline: Column) -> tuple[DataFrame, DataFrame]:
    """(files of the feeds that may be taken in, problems (feed, n_off, first_off)): one file off the baseline refuses its whole feed."""
    off = off_baseline(files, name, baseline).groupBy(feed).agg(F.count("*").alias("n_off"), F.min(name).alias("first_off"))
    return files.join(off.select(feed), feed, "left_anti"), off


def off_baseline(files: DataFrame, name: str, baseline: Column) -> DataFrame:
    """Files whose name doesn't carry the baseline's day (yyyyMMdd); a feed with any is not taken in."""
    stamp = F.try_to_timestamp(F.regexp_extract(name, r"([0-9]{8})", 1), F.lit("yyyyMMdd")).cast("date")
    return files.withColumn("stamp", stamp).where(~F.coalesce(F.col("stamp") == baseline, F.lit(False)))


def write_partition(df: DataFrame, path: str, *by: str) -> None:
    """Replace only the partitions that ``df`` has rows of."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def append_manifest(entries: DataFrame, path: str) -> None:
    entries.write.mode("append").json(path)
