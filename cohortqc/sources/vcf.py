"""Reading and writing VCF as long tables.

A scan gives one row per site, with the header's INFO fields as typed columns and the samples' columns still as
one array; entries are exploded from it only where they are used. The header is read on the driver, up to the first record.
Block-compressed files (whatever their ending; most .gz files of this kind are) are divided at blocks and read by several
tasks; a plain gzip file cannot be divided and is streamed by one task.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortqc.session import materialize, release

PATTERN = r"vcf\.b?gz$"
FIXED = ("chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", "format")
_TYPES = {"Integer": "int", "Float": "double", "String": "string", "Character": "string", "Flag": "boolean"}
_META = re.compile(r"##(INFO|FORMAT|FILTER|contig)=<(.*)>")
_ITEM = re.compile(r'(\w+)=("(?:[^"\\]|\\.)*"|[^,]*)')


@dataclass(frozen=True)
class Field:
    name: str
    number: str
    kind: str
    description: str = ""

    @property
    def type(self) -> str:
        base = _TYPES.get(self.kind, "string")
        return base if self.kind == "Flag" or self.number in ("0", "1") else f"array<{base}>"


@dataclass(frozen=True)
class Header:
    info: dict[str, Field]
    format: dict[str, Field]
    samples: list[str]
    lines: list[str]


def parse_header(lines: Sequence[str]) -> Header:
    info: dict[str, Field] = {}
    form: dict[str, Field] = {}
    samples: list[str] = []
    for line in lines:
        if m := _META.match(line):
            items = {k: v.strip('"') for k, v in _ITEM.findall(m[2])}
            if m[1] in ("INFO", "FORMAT"):
                (info if m[1] == "INFO" else form)[items["ID"]] = Field(items["ID"], items.get("Number", "."), items.get("Type", "String"), items.get("Description", ""))
        elif line.startswith("#CHROM"):
            samples = line.rstrip("\r\n").split("\t")[9:]
    return Header(info, form, samples, [x.rstrip("\r\n") for x in lines])


def list_files(spark: SparkSession, folder: str, pattern: str = PATTERN) -> list[str]:
    """The files of a folder whose name matches."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    status = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(str(s.getPath()) for s in status if re.search(pattern, s.getPath().getName()))


#: Compressed bytes of a file that one task unpacks.
SPLIT_BYTES = 32 * 2**20
_BATCH_BYTES = 8 * 2**20


def _open(path: str):
    """A file of any file system that Arrow knows, for random reads."""
    from pyarrow import fs

    if re.match(r"file:/(?!/)", path):
        path = "file://" + path[5:]
    system, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return system.open_input_file(name)


def block_size(head: bytes) -> int:
    """Bytes of the block that begins with ``head``, 0 if none does: gzip with the extra field BC."""
    if len(head) < 18 or head[:4] != b"\x1f\x8b\x08\x04":
        return 0
    at, end = 12, 12 + int.from_bytes(head[10:12], "little")
    while at + 6 <= min(end, len(head)):
        size = int.from_bytes(head[at + 2 : at + 4], "little")
        if head[at : at + 2] == b"BC" and size == 2:
            return int.from_bytes(head[at + 4 : at + 6], "little") + 1
        at += 4 + size
    return 0


_HEAD = 64
_LARGEST = 65_536


def _first_block(file, at: int, size: int) -> int:
    """Where the first block at or behind ``at`` begins; a block counts only if another one or the end follows it."""
    file.seek(at)
    data = file.read(min(2 * _LARGEST + _HEAD, size - at))
    k = data.find(b"\x1f\x8b\x08\x04")
    while k >= 0:
        n = block_size(data[k : k + _HEAD])
        if n and (at + k + n == size or block_size(data[k + n : k + n + _HEAD])):
            return at + k
        k = data.find(b"\x1f\x8b\x08\x04", k + 1)
    return size


def _blocks(file, at: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(where it begins, content) of the blocks from ``at`` on."""
    while at < size:
        file.seek(at)
        head = file.read(_HEAD)
        n = block_size(head)
        if not n:
            raise ValueError(f"no block at byte {at}")
        extra = int.from_bytes(head[10:12], "little")
        data = head[:n] + file.read(max(0, n - len(head)))
        yield at, zlib.decompress(data[12 + extra : n - 8], -15)
        at += n


def split_lines(path: str, start: int, stop: int) -> Iterator[bytes]:
    """Lines of a block-compressed file that belong to bytes start..stop: those that begin behind the first line end in the
    split's first block (the file's first line for start 0), up to the one that holds the next split's first line end."""
    with _open(path) as file:
        size = file.size()
        first = _first_block(file, start, size) if start else 0
        if first >= stop and start:
            return
        behind = _first_block(file, stop, size) if stop < size else size
        skipping, rest, ended = bool(start), b"", False
        for at, data in _blocks(file, first, size):
            if at >= behind:  # the line that is open here, or begins here, is still ours
                end = data.find(b"\n")
                rest += data if end < 0 else data[: end + 1]
                if end < 0:
                    continue
                ended = True
            else:
                rest += data
            if skipping:
                end = rest.find(b"\n")
                if end < 0:
                    if ended:
                        return
                    rest = b""
                    continue
                rest, skipping = rest[end + 1 :], False
            lines = rest.split(b"\n")
            rest = lines.pop()
            yield from lines
            if ended:
                return
        if rest and not skipping:
            yield rest


def _stream_lines(path: str, compressed: bool) -> Iterator[bytes]:
    """Lines of a plain or a gzip file of one or several members, read on."""
    unpack = zlib.decompressobj(31) if compressed else None
    with _open(path) as file:
        rest = b""
        while data := file.read(2**20):
            text = b"" if unpack else data
            while unpack and data:
                text += unpack.decompress(data)
                data = unpack.unused_data
                if unpack.eof:
                    unpack = zlib.decompressobj(31)
            lines = (rest + text).split(b"\n")
            rest = lines.pop()
            yield from lines
        if rest:
            yield rest


def _kind(path: str) -> str:
    """plain, gzip or blocks, by content."""
    with _open(path) as file:
        head = file.read(_HEAD)
    return "blocks" if block_size(head) else "gzip" if head[:2] == b"\x1f\x8b" else "plain"


def _text_of(line: bytes) -> str:
    return line.rstrip(b"\r").decode("utf-8", "replace")


def _files(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, int]]:
    """(path, bytes) of files, and of the files in folders."""
    jvm, out = spark.sparkContext._jvm, []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        status = system.globStatus(path)
        if not status:
            raise FileNotFoundError(p)
        for s in status:
            inner = sorted(system.listStatus(s.getPath()), key=lambda x: x.getPath().getName()) if s.isDirectory() else [s]
            out += [(str(x.getPath().toString()), int(x.getLen())) for x in inner if not x.getPath().getName().startswith(("_", "."))]
    return out


def _lines(spark: SparkSession, paths: Sequence[str], split_bytes: int | None = None) -> DataFrame:
    """Lines of plain, gzip and block-compressed files."""
    plain, splits = [], []
    for path, size in _files(spark, paths):
        if not re.search(r"\.b?gz$", path):
            plain.append(path)
        elif _kind(path) == "blocks":
            step = split_bytes or SPLIT_BYTES
            splits += [(path, k * step, min(size, (k + 1) * step), True) for k in range(max(1, math.ceil(size / step)))]
        else:
            splits.append((path, 0, size, False))
    parts = [spark.read.text(plain).select("value")] if plain else []
    if splits:

        def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    held, size = [], 0
                    for line in split_lines(row["path"], row["start"], row["stop"]) if row["blocks"] else _stream_lines(row["path"], row["path"].endswith("gz")):
                        held.append(_text_of(line))
                        size += len(line)
                        if size > _BATCH_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], ["value"])
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], ["value"])

        table = spark.createDataFrame([(k, *x) for k, x in enumerate(splits)], "k int, path string, start long, stop long, blocks boolean")
        parts.append(table.repartitionById(len(splits), F.col("k")).mapInArrow(unpack, "value string"))
    if not parts:
        raise FileNotFoundError(f"no VCF files in {list(paths)}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_header(spark: SparkSession, path: str) -> Header:
    """The header lines of one file (of a folder its first), however many: reading ends at the first record."""
    name, size = _files(spark, [path])[0]
    kind = _kind(name)
    head = []
    for line in split_lines(name, 0, size) if kind == "blocks" else _stream_lines(name, kind == "gzip"):
        if not line.startswith(b"#"):
            break
        head.append(_text_of(line))
    header = parse_header(head)
    if not any(x.startswith("#CHROM") for x in head):
        raise ValueError(f"{path}: no #CHROM line before the first record")
    return header


def _value(text: Column, f: Field) -> Column:
    """Typed value of a field's text; '.' is missing, also as an element."""
    base = _TYPES.get(f.kind, "string")
    if f.type.startswith("array"):
        parts = F.transform(F.split(text, ","), lambda x: F.when(x != ".", x).try_cast(base))
        return F.when(text.isNotNull() & (text != "."), parts)
    return F.when(text != ".", text).try_cast(base)


def read_sites(spark: SparkSession, paths: str | list[str], header: Header | None = None, info: Sequence[str] | None = None, split_samples: bool = True) -> DataFrame:
    """(contig, pos, rsid, alleles, qual, filters, info struct[, format, calls]) of one or more files.

    ``header`` may come from another file. ``info`` limits the INFO fields. Without ``split_samples`` the samples'
    columns are not even kept apart: a sites-only scan.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    header = header or read_header(spark, paths[0])
    cols = F.split("value", "\t")
    at = lambda k: F.get(cols, F.lit(k))
    items = F.transform(F.split(at(7), ";"), lambda x: F.struct(F.split_part(x, F.lit("="), F.lit(1)).alias("k"), F.when(x.contains("="), F.regexp_replace(x, "^[^=]*=", "")).alias("v")))
    fields = [header.info[n] for n in (info if info is not None else header.info)]

    def get(f: Field) -> Column:
        own = F.get(F.filter("items", lambda x: x["k"] == f.name), F.lit(0))
        return (own.isNotNull() if f.kind == "Flag" else _value(own["v"], f)).alias(f.name)

    rows = _lines(spark, paths).where("value not like '#%' and value <> ''").select(
        at(0).alias("contig"), at(1).cast("int").alias("pos"), F.when(at(2) != ".", at(2)).alias("rsid"), F.concat(F.array(at(3)), F.when(at(4) == ".", F.array().cast("array<string>")).otherwise(F.split(at(4), ","))).alias("alleles"),
        at(5).try_cast("double").alias("qual"), F.when(at(6) == "PASS", F.array().cast("array<string>")).when(at(6) != ".", F.split(at(6), ";")).alias("filters"), items.alias("items"),
        *([F.split(at(8), ":").alias("format"), F.slice(cols, 10, F.greatest(F.lit(0), F.size(cols) - 9)).alias("calls")] if split_samples else []),
    )
    extra = F.struct(*[get(f) for f in fields]).alias("info") if fields else F.lit(None).cast("struct<none:string>").alias("info")
    return rows.select("contig", "pos", "rsid", "alleles", "qual", "filters", extra, *(["format", "calls"] if split_samples else []))


def call_struct(text: Column) -> Column:
    """'0/1', '1|0' or '1' as struct(a0, a1, phased); null if a part is missing."""
    parts = F.split(text, "[/|]")
    a, b = F.get(parts, F.lit(0)).try_cast("int"), F.coalesce(F.get(parts, F.lit(1)), F.get(parts, F.lit(0))).try_cast("int")
    return F.when(a.isNotNull() & b.isNotNull(), F.struct(a.alias("a0"), b.alias("a1"), text.contains("|").alias("phased")))


def explode_entries(sites: DataFrame, header: Header, fields: Sequence[str] | None = None) -> DataFrame:
    """One row per site and sample with the FORMAT fields in lower case; gt and pgt as calls."""
    names = F.array(*[F.lit(s) for s in header.samples]) if header.samples else F.array().cast("array<string>")
    e = sites.select("contig", "pos", "alleles", "format", F.posexplode("calls").alias("_k", "_call")).select("contig", "pos", "alleles", "format", F.get(names, F.col("_k")).alias("s"), F.split("_call", ":").alias("_v"))
    wanted = [f for n, f in header.format.items() if fields is None or n in fields or n.lower() in fields]

    def get(f: Field) -> Column:
        text = F.get("_v", F.array_position("format", f.name).cast("int") - 1)
        text = F.when(F.array_contains("format", f.name), text)
        return (call_struct(text) if f.name in ("GT", "PGT") else _value(text, f)).alias(f.name.lower())

    return e.select("contig", "pos", "alleles", "s", *[get(f) for f in wanted])


def load_folder(spark: SparkSession, folder: str, header_file: str | None = None) -> tuple[DataFrame, Header]:
    """All files of a folder as one table of sites with calls; the header may be a file of its own."""
    files = list_files(spark, folder)
    if not files:
        raise FileNotFoundError(f"no VCF files in {folder}")
    header = read_header(spark, header_file or files[0])
    return read_sites(spark, files, header), header


# ---- writing ------------------------------------------------------------------------------------------------------------
def format_call(call: Column) -> Column:
    sep = F.when(call["phased"], "|").otherwise("/")
    return F.when(call.isNull(), "./.").otherwise(F.concat(call["a0"].cast("string"), sep, call["a1"].cast("string")))


def _text(c: Column, kind: str) -> Column:
    if kind.startswith("array"):
        parts = F.transform(c, lambda x: F.coalesce(x.cast("string"), F.lit(".")))
        return F.coalesce(F.when(F.size(c) > 0, F.array_join(parts, ",")), F.lit("."))
    return F.coalesce(c.cast("string"), F.lit("."))


def vcf_lines(sites: DataFrame, entries: DataFrame, samples: Sequence[str], info: Sequence[str] = (), formats: Sequence[str] = ("gt",), key: Sequence[str] = ("contig", "pos", "alleles")) -> DataFrame:
    """(contig, pos, alleles, line): one VCF line per site; a sample without entry has a missing call.

    ``samples`` is the order of the columns. The calls of a site are collected into one row, which is what a line is; of
    several entries of a sample the smallest counts.
    """
    kinds = dict(entries.dtypes)
    value = lambda f: format_call(F.col(f)) if kinds[f].startswith("struct") else _text(F.col(f), kinds[f])
    cell = F.concat_ws(":", *[value(f) for f in formats])
    spark = sites.sparkSession
    empty = ":".join("./." if kinds[f].startswith("struct") else "." for f in formats)
    # calls go by their sample's number; between two of them, and at either end, the missing ones are filled in
    number = F.broadcast(spark.createDataFrame([(s, k) for k, s in enumerate(samples)], "s string, _k int"))  # as many as the columns of a line
    per = entries.join(number, "s").select(*key, "_k", cell.alias("_v")).groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("_k", "_v"))).alias("_cells"))
    before = lambda i: F.coalesce(F.get("_cells", i - 1)["_k"], F.lit(-1))
    blank = lambda n: F.repeat(F.lit("\t" + empty), n)
    filled = F.transform("_cells", lambda x, i: F.when(x["_k"] > F.when(i > 0, before(i)).otherwise(-1), F.concat(blank(x["_k"] - F.when(i > 0, before(i)).otherwise(-1) - 1), F.lit("\t"), x["_v"])))
    last = F.coalesce(F.element_at("_cells", -1)["_k"], F.lit(-1))
    calls = F.when(F.size("_cells") > 0, F.concat(F.array_join(filled, ""), blank(F.lit(len(samples) - 1) - last))).otherwise(blank(F.lit(len(samples))))
    site_kinds = dict(sites.dtypes)

    def item(n: str) -> Column:
        c = F.col(n)
        if site_kinds[n] == "boolean":
            return F.when(c, F.lit(n))
        return F.when(c.isNotNull(), F.concat(F.lit(f"{n}="), _text(c, site_kinds[n])))

    text = F.concat_ws(";", *[item(n) for n in info]) if info else F.lit("")
    has = lambda n, other: F.coalesce(F.col(n).cast("string"), F.lit(other)) if n in site_kinds else F.lit(other)
    filters = F.when(F.size("filters") == 0, "PASS").otherwise(F.coalesce(F.array_join("filters", ";"), F.lit("."))) if "filters" in site_kinds else F.lit(".")
    j = sites.join(per, list(key), "left")
    alt = F.array_join(F.slice("alleles", 2, F.greatest(F.lit(0), F.size("alleles") - 1)), ",")
    front = F.concat_ws(
        "\t", "contig", F.col("pos").cast("string"), has("rsid", "."), F.get("alleles", F.lit(0)), F.when(alt != "", alt).otherwise("."), has("qual", "."), filters, F.when(text != "", text).otherwise("."), F.lit(":".join(f.upper() for f in formats))
    )
    return j.select("contig", "pos", "alleles", F.concat(front, calls).alias("line"))


def header_lines(samples: Sequence[str], contigs: Sequence[str] = (), info: Sequence[Field] = (), formats: Sequence[Field] = ()) -> list[str]:
    meta = ["##fileformat=VCFv4.2", *[f"##contig=<ID={c}>" for c in contigs]]
    for name, fields in (("INFO", info), ("FORMAT", formats)):
        meta += [f'##{name}=<ID={f.name},Number={f.number},Type={f.kind},Description="{f.description}">' for f in fields]
    return [*meta, "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *samples])]


#: Sites of one written file.
PART_SITES = 200_000


#: Bytes of text in one written block.
BLOCK_TEXT = 65_280


def block(data: bytes) -> bytes:
    """One block of at most BLOCK_TEXT bytes: a gzip member with its own length in the extra field BC."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    if len(body) > _LARGEST - 26:  # cannot be made smaller: stored as it is
        deflate = zlib.compressobj(0, zlib.DEFLATED, -15)
        body = deflate.compress(data) + deflate.flush()
    size = (len(body) + 25).to_bytes(2, "little")
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + size + body + zlib.crc32(data).to_bytes(4, "little") + len(data).to_bytes(4, "little")


def _write_blocks(rows: DataFrame, path: str) -> None:
    """Rows (contig, value), ordered within partitions, as block-compressed files in a folder per contig.

    A task writes under a name of its own and renames what is complete, so a repeated task leaves no second file.
    """
    spark = rows.sparkSession
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.delete(target, True)
    root = str(system.makeQualified(target).toString())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        task = TaskContext.get()
        system, base = fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", root))
        name, files, out, now, held = f"part-{task.partitionId():06d}.vcf.bgz", 0, None, None, bytearray()

        def close() -> None:
            for k in range(0, len(held), BLOCK_TEXT):
                out.write(block(bytes(held[k : k + BLOCK_TEXT])))
            out.write(block(b""))
            out.close()
            target = f"{base}/contig={now}/{name}"
            if system.get_file_info(target).type != fs.FileType.NotFound:  # of an earlier attempt
                system.delete_file(target)
            system.move(f"{base}/_{task.taskAttemptId()}-{now}", target)
            held.clear()

        for batch in batches:
            for contig, value in zip(batch.column("contig").to_pylist(), batch.column("value").to_pylist(), strict=True):
                if contig != now:
                    if out is not None:
                        close()
                    now, files = contig, files + 1
                    system.create_dir(f"{base}/contig={now}", recursive=True)
                    out = system.open_output_stream(f"{base}/_{task.taskAttemptId()}-{now}", compression=None)
                held += value.encode() + b"\n"
                if len(held) >= 16 * BLOCK_TEXT:
                    whole = len(held) // BLOCK_TEXT * BLOCK_TEXT
                    for k in range(0, whole, BLOCK_TEXT):
                        out.write(block(bytes(held[k : k + BLOCK_TEXT])))
                    del held[:whole]
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([files], pa.int64())], ["files"])

    rows.select("contig", "value").mapInArrow(write, "files long").agg(F.sum("files")).collect()


def write_by_contig(lines: DataFrame, header: Sequence[str], path: str, contigs: Sequence[str] | None = None, part_sites: int = PART_SITES, blocks: bool = False) -> None:
    """One folder per contig in a single job; its files, joined in the order of their names, are one sorted VCF file.
    They are gzip files, or with ``blocks`` block-compressed ones.

    Sites are parted by ranges of (contig, pos), so that a chromosome is written by several tasks; the first of its
    files begins with the header.
    """
    if contigs is not None:
        lines = lines.where(F.col("contig").isin(*contigs))
    lines = materialize(lines.select("contig", "pos", "alleles", "line"))
    head = lines.select("contig").distinct().select("contig", F.posexplode(F.array(*[F.lit(x) for x in header])).alias("_n", "line"))
    head = head.select("contig", (F.col("_n") - len(header)).cast(lines.schema["pos"].dataType).alias("pos"), F.lit(None).cast("array<string>").alias("alleles"), "line")
    both = head.unionByName(lines)
    order = ("contig", "pos", "alleles")
    parts = max(1, math.ceil(lines.count() / part_sites))
    rows = both.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("contig", F.col("line").alias("value"))
    if blocks:
        _write_blocks(rows, path)
    else:
        rows.write.partitionBy("contig").mode("overwrite").option("compression", "gzip").text(path)
    release(lines)
