"""WARC archives with deduplicated payloads, and one globally ordered index over them.

Writing: every task writes gzip members, one per record, to archive files in a shared folder and
returns capture runs, stretches of ``RUN_ENTRIES`` index entries sorted by URL key, timestamp and page id.
Merging: runs are cut into blocks of ``BLOCK`` entries, and each key range gets its blocks in the order of their
first entries (Spark's range shuffle and spilling sort). A loser tree merges them as they come: a block is read
when the merge reaches its first entry, and the former block of its run is used up by then, so a task holds one
block of each run, whatever the length of a range or a URL's history. More than ``FAN_IN`` runs are first merged
in groups of about so many to longer runs, in as many passes as it takes; a pass is a stored table.
Reading: the merged index, ordered by archive and offset, leads to each record's bytes.

Of records with equal payloads the one of the smallest page id holds the payload (``response``); the others
are ``revisit`` records that name it. Payloads are told apart by SHA-256; the digest written is SHA-1 in base32.

Defined results: a null html counts as an empty payload; a null url is written as an empty one; the rows of a
repeated page id are records of their own, and a row equal to the response in id and payload is a response too;
a null page id is never the smallest where others exist; a page id that is a string is percent-encoded in its record.
Equal entries of the index keep the order of their runs.

A task that runs again writes files of new names; only files named by the stored runs are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone
from itertools import islice
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortline.session import ensure_checkpoint_dir

from .common import arrow_schema, partitions, store

# An archive is closed once it holds so many bytes.
ARCHIVE_BYTES = 64 << 20
# Entries of a run, which its task sorts in memory, and of a block of it, which a merge holds.
RUN_ENTRIES = 1024
BLOCK = 128
# Runs that one merge takes in.
FAN_IN = 256
# Rows that a merge returns at a time.
OUT_ROWS = 1000
# WARC-Date of records without a time of capture.
EPOCH = datetime(2000, 1, 1, tzinfo=timezone.utc)

_ENTRY = ("url_key string, capture string, page_id {id}, archive string, offset long, length long, "
          "payload_bytes long, payload_digest string, record_type string, refers_to {id}")
# ``block`` is the position of the block's first entry, which the head columns describe.
_RUN = "run string, run_pos long, block long, head_key string, head_capture string, head_page {id}, " + _ENTRY
_INDEX = "run string, run_pos long, " + _ENTRY + ", shard int, position long"
_READ = "page_id {id}, payload_bytes long, payload_digest string, record_type string, refers_to {id}, url string, payload binary"


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder URI (``file:``, ``hdfs:``, ``s3:``, ``gs:`` or a plain path)."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri) if ":" in uri else f"file://{uri}")


def url_key(url: str) -> str:
    """Sort key of a URL: host labels from the top level down, then port, path and query, without scheme and fragment."""
    rest = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", url).split("#", 1)[0]
    host, slash, path = rest.partition("/")
    host = host.rsplit("@", 1)[-1].lower()
    name, _, port = host.partition(":")
    name = re.sub(r"^www\d*\.", "", name)
    return ",".join(reversed(name.split("."))) + (f":{port}" if port not in ("", "80", "443") else "") + ")" + (slash + path or "/")


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def urn(page) -> str:
    """The record id of a page; that of a null id has no third part."""
    return "<urn:page>" if page is None else f"<urn:page:{quote(str(page), safe='')}>"


def page_of(name: str | None, number: bool):
    """The page id of ``urn``."""
    if name in (None, "<urn:page>"):
        return None
    text = unquote(name[len("<urn:page:"):-1])
    return int(text) if number else text


def record(page, url: str, when: str, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record. A revisit keeps the HTTP header, with the payload's length, but not the payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {urn(page)}",
            f"WARC-Date: {when}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {urn(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).replace("\0", "").encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC header, HTTP header and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), payload


def with_responses(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, capture, refers_to): ``refers_to`` is null for the response of each payload."""
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    keyed = pages.withColumn("html", html).withColumn("_sum", F.sha2("html", 256))
    slim = keyed.select("_sum", "page_id")
    least = slim.groupBy("_sum").agg(F.min("page_id").alias("response"), F.count("*").alias("n")).filter("n > 1")
    # only payloads met more than once need a second look; a join of two shuffled sides, so a hot payload can be split
    again = (slim.join(least, "_sum").filter(~F.col("page_id").eqNullSafe(F.col("response")))
             .groupBy("page_id", "_sum").agg(F.first("response").alias("refers_to")))
    again = again.withColumnsRenamed({"page_id": "_page", "_sum": "_again"})
    return (keyed.join(again, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("_sum") == F.col("_again")), "left")
            .select("page_id", "url", "html", "capture", "refers_to"))


def ordered(url_key: str, capture: str, page) -> tuple:
    """The order of entries, null page ids first."""
    return url_key, capture, page is not None, 0 if page is None else page


def struct(fields: str, rows: DataFrame) -> T.StructType:
    """The fields, with the type of the rows' page ids."""
    return T.StructType.fromDDL(fields.format(id=rows.schema["page_id"].dataType.simpleString()))


def batches_of(rows: Iterable[tuple], fields: T.StructType) -> Iterator[pa.RecordBatch]:
    target, rows = arrow_schema(fields), iter(rows)
    while part := list(islice(rows, OUT_ROWS)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), target)], schema=target)


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, run_entries: int = RUN_ENTRIES,
                   block: int = BLOCK) -> DataFrame:
    """Writes (page_id, url, html, capture, refers_to) to ``folder``; the capture runs."""
    fields = struct(_RUN, pages)

    def run(entries):
        entries.sort(key=lambda e: (ordered(*e[:3]), e[4]))
        name = uuid.uuid4().hex
        for i, entry in enumerate(entries):
            if i % block == 0:
                head = i, *entry[:3]
            yield name, i, *head, *entry

    def write(batches):
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        out, entries, name = None, [], ""
        for batch in batches:
            for page, url, html, when, refers in zip(*(batch.column(c) for c in ("page_id", "url", "html", "capture", "refers_to"))):
                page, url, payload, when, refers = page.as_py(), url.as_py() or "", html.as_py(), when.as_py(), refers.as_py()
                url = re.sub(r"[\r\n]", "", url)
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                digest = digest32(payload)
                member = gzip.compress(record(page, url, when, payload, digest, refers), compresslevel=1, mtime=0)
                entries.append((url_key(url), when, page, name, out.tell(), len(member), len(payload), digest,
                                "revisit" if refers is not None else "response", refers))
                out.write(member)
                full = out.tell() >= archive_bytes
                if full:
                    out.close()
                    out = None
                if full or len(entries) >= run_entries:
                    yield from batches_of(run(entries), fields)
                    entries = []
        if out is not None:
            out.close()
        yield from batches_of(run(entries), fields)

    return pages.mapInArrow(write, fields)


class LoserTree:
    """k-way merge: each inner node keeps the loser of its match, so the next winner costs one path to the root."""

    def __init__(self, sources: list):
        self.sources = [iter(s) for s in sources]
        self.k = max(1, len(sources))
        self.heads = [next(s, None) for s in self.sources] + [None] * (self.k - len(sources))
        self.losers = [-1] * self.k
        for i in range(self.k):
            self._play(i)

    def _before(self, a: int, b: int) -> bool:
        """Whether source ``a`` wins against ``b``; an empty source loses, ties go to the lower number."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return x is not None or (y is None and a < b)
        return (x, a) < (y, b)

    def _play(self, i: int) -> None:
        node = (i + self.k) // 2
        while node:
            if self.losers[node] == -1:          # the first to arrive waits for the other side
                self.losers[node] = i
                return
            if self._before(self.losers[node], i):
                self.losers[node], i = i, self.losers[node]
            node //= 2
        self.losers[0] = i

    def __iter__(self):
        while self.heads[w := self.losers[0]] is not None:
            yield w, self.heads[w]
            self.heads[w] = next(self.sources[w], None)
            self._play(w)


def blocks_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, list, list]]:
    """(head, keys, rows) of each block of (group, *run columns), in the order in which they come."""
    last, keys, rows = None, [], []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            group, run, pos, block = row[:4]
            if (run, block) != last and rows:
                yield head, keys, rows
                keys, rows = [], []
            if not rows:
                last, head = (run, block), (group, *ordered(*row[4:7]), run, block)
            keys.append((group, *ordered(*row[7:10]), run, pos))
            rows.append(row)
    if rows:
        yield head, keys, rows


def merged(blocks: Iterable[tuple[tuple, list, list]]) -> Iterator[tuple]:
    """The rows of sorted blocks in one order; the blocks come in the order of their heads.

    A block is read once no open entry comes before its head, so of each run one block is open at a time.
    """
    blocks, held = iter(blocks), []
    coming = next(blocks, None)
    while coming is not None or held:
        least = min((keys[at] for keys, _, at in held), default=None)
        while coming is not None and (least is None or coming[0] <= least):
            held.append([coming[1], coming[2], 0])
            least = coming[1][0] if least is None else min(least, coming[1][0])
            coming = next(blocks, None)
        for source, key in LoserTree([islice(keys, at, None) for keys, _, at in held]):
            if coming is not None and coming[0] <= key:
                break
            yield held[source][1][held[source][2]]
            held[source][2] += 1
        held = [h for h in held if h[2] < len(h[0])]


def merge_runs(runs: DataFrame, ranges: int | None = None, fan_in: int = FAN_IN, block: int = BLOCK) -> DataFrame:
    """The entries of all runs in one order of (url_key, capture, page_id): by ``shard``, then ``position`` in it.

    ``runs`` is read more than once, so it should be stored.
    """
    longer_fields, index_fields = struct(_RUN, runs), struct(_INDEX, runs)
    n_ranges = ranges or partitions(runs.sparkSession)

    def dealt(groups: int) -> DataFrame:
        group = F.pmod(F.xxhash64("run"), F.lit(groups)).alias("group")
        return (runs.select(group, *runs.columns).repartitionByRange(n_ranges, "group", "url_key", "capture", "page_id", "run", "run_pos")
                .sortWithinPartitions("group", "head_key", "head_capture", "head_page", "run", "block", "run_pos"))

    def longer(level: int):
        """A pass: each group of runs becomes one run."""
        def entries(batches):
            from pyspark import TaskContext

            start, last = TaskContext.get().partitionId() << 32, None
            for i, row in enumerate(merged(blocks_of(batches))):
                if row[0] != last or i - head[0] + start >= block:
                    head = start + i, *row[7:10]
                last = row[0]
                yield f"{level}-{row[0]}", start + i, *head, *row[7:]

        return lambda batches: batches_of(entries(batches), longer_fields)

    def index(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        rows = ((*row[1:3], *row[7:], shard, i) for i, row in enumerate(merged(blocks_of(batches))))
        return batches_of(rows, index_fields)

    level = 0
    while (n := runs.select("run").distinct().count()) > fan_in:
        level += 1
        runs = store(dealt(-(-n // fan_in)).mapInArrow(longer(level), longer_fields))
    return dealt(1).mapInArrow(index, index_fields)


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Each indexed record as read from its archive; a revisit's payload is null, its length that of the full one."""
    id_name = index.schema["page_id"].dataType.simpleString()
    fields = _READ.format(id=id_name)
    names = T.StructType.fromDDL(fields).names
    number = id_name in ("tinyint", "smallint", "int", "bigint")

    def read(batches):
        fs, root = filesystem(folder)
        name, file = None, None
        for batch in batches:
            rows = []
            id_type = batch.schema.field("page_id").type
            for archive, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))):
                if archive != name:
                    if file is not None:
                        file.close()
                    name, file = archive, fs.open_input_file(f"{root}/{archive}")
                file.seek(offset)
                warc, http, payload = parse(gzip.decompress(file.read(length)))
                digest = warc["WARC-Payload-Digest"].removeprefix("sha1:")
                revisit = warc["WARC-Type"] == "revisit"
                if not revisit and digest32(payload) != digest:
                    raise ValueError(f"{archive} at {offset}: the payload does not match its digest")
                page, refers = (page_of(warc.get(k), number) for k in ("WARC-Record-ID", "WARC-Refers-To"))
                rows.append((page, int(http["Content-Length"]), digest, warc["WARC-Type"], refers, warc["WARC-Target-URI"],
                             None if revisit else payload))
            types = [id_type, pa.int64(), pa.string(), pa.string(), id_type, pa.string(), pa.binary()]
            columns = list(zip(*rows)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
        if file is not None:
            file.close()

    ordered = index.select("archive", "offset", "length", "page_id").repartitionByRange(partitions(index.sparkSession), "archive", "offset")
    return ordered.sortWithinPartitions("archive", "offset").mapInArrow(read, fields)


def archive_pages(pages: DataFrame, folder: str | None = None, capture_col: str | None = None,
                  archive_bytes: int = ARCHIVE_BYTES, run_entries: int = RUN_ENTRIES) -> tuple[DataFrame, str]:
    """Writes a record per page; (merged index as a stored table, folder of the archives).

    Without ``folder`` the archives stand beside the stored tables and go with them (``drop_checkpoints``).
    """
    spark = pages.sparkSession
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/warc-{uuid.uuid4().hex}"
    when = F.lit(EPOCH.strftime("%Y-%m-%dT%H:%M:%SZ"))
    if capture_col is not None:
        utc = F.to_utc_timestamp(capture_col, F.current_timezone())
        when = F.coalesce(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'"), when)
    src = pages.select("page_id", F.col("url").cast("string").alias("url"), "html", when.alias("capture"))
    runs = store(write_archives(with_responses(src), folder, archive_bytes, run_entries))
    return store(merge_runs(runs)), folder
