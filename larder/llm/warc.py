"""WARC archives, read in parallel with boundary-chain verification.

Writing: one record per page; of pages with equal payloads the one with the
largest id is a ``response``, the others are ``revisit`` records that refer to
it. Every task writes one uncompressed file to the shared folder.

Reading: a file is cut into byte ranges, one task each. A range may begin
anywhere and payloads may contain record magic, so a task only emits
*candidates*: every offset in its range that looks like a record, with the
offset its header claims for the record's successor, followed inside the range
up to the first offset beyond it. Pointer jumping from offset 0 of each file
(joins; the pointers double every round) marks the candidates that a chain of
records really reaches; magic inside payloads is never reached. A second pass
reads each range from its first reached record.

Defined results: a null payload is empty; a null page id is written as such,
and never is a response while an equal payload has an id; rows that repeat
both id and payload are all responses; a null url gives no target header; an
empty table gives no archive and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import prepare_python, publish_file, saved, shared_path, table

MAGIC = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
#: The pages table has no crawl time.
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Production parameter: bytes of a range.
RANGE = 32 << 20
#: Bytes read at a time while a header is looked for.
STEP = 1 << 16
#: Bits of a digest that address the filter of repeated digests: the first if it
#: then has 64 bits a digest, else the second (2 and 32 MiB).
FILTER_BITS = (24, 28)


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page) -> str:
    return f"<urn:x-page:{'' if page is None else page}>"


def page_of(uri: str | None) -> int | None:
    m = re.fullmatch(r"<urn:x-page:(-?\d+)>", uri or "")
    return m[1] if m else None


def record(page, url: str | None, payload: bytes, refers_to) -> bytes:
    """One WARC record; ``refers_to`` is the page it revisits, else None."""
    head = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
            + str(len(payload)).encode() + END)
    block = head if refers_to is not None else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: {record_id(page)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest32(payload)}", "Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + END + block + END


def with_responses(pages: DataFrame) -> DataFrame:
    """page_id, url, html and ``_to``: the page a row revisits, else null.

    Payloads stay where they were scanned unless an equal one may exist: a bit
    table (2 or 32 MiB by their number, broadcast) over the digests that occur
    twice tells which rows have to meet their digest's largest id in a join."""
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumn("_key", F.sha1(F.encode("html", "UTF-8")))
    twice = saved(p.groupBy("_key").agg(F.max("page_id").alias("_of"), F.count(F.lit(1)).alias("_n"))
                  .filter("_n > 1").select("_key", "_of"), "warc-twice")
    bits = FILTER_BITS[64 * twice.count() > 1 << FILTER_BITS[0]]
    slot = F.conv(F.substring("_key", 1, bits // 4), 16, 10).cast("long")
    words = (twice.select(slot.alias("slot")).groupBy(F.shiftright("slot", 5).alias("word"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"),
                                           F.col("slot").bitwiseAND(31).cast("int"))).alias("bits")).toPandas())
    table_ = np.zeros(1 << (bits - 5), np.uint32)
    table_[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    sent = pages.sparkSession.sparkContext.broadcast(table_)

    @F.pandas_udf("boolean")
    def may_repeat(slots: pd.Series) -> pd.Series:
        at = slots.to_numpy(np.int64)
        return pd.Series((sent.value[at >> 5] >> (at & 31).astype(np.uint32) & 1).astype(bool))

    columns = ["page_id", "url", "html"]
    alone = p.filter(~may_repeat(slot)).select(*columns, F.lit(None).cast("long").alias("_to"))
    to = F.when(~F.col("page_id").eqNullSafe(F.col("_of")), F.col("_of"))
    shared = p.filter(may_repeat(slot)).join(twice, "_key", "left").select(*columns, to.alias("_to"))
    return alone.union(shared)


def write_archives(pages: DataFrame, folder: str) -> list[dict]:
    """Write (page_id, url, html) and return one small row per file."""
    prepare_python(pages.sparkSession)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs
        store = sink = None
        part, size, n = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for page, url, html, to in zip(*(batch[c].astype(object).where(batch[c].notna(), None)
                                             for c in ("page_id", "url", "html", "_to"))):
                if sink is None:
                    store, path = fs.FileSystem.from_uri(folder)
                    store.create_dir(path, recursive=True)
                    own = f"{path}/_part-{part:06d}-{TaskContext.get().taskAttemptId()}"
                    sink = store.open_output_stream(own)
                raw = record(page, url, html.encode("utf-8", "replace"), to)
                sink.write(raw)
                size, n = size + len(raw), n + 1
        if sink is not None:
            sink.close()
            publish_file(store, own, f"{path}/part-{part:06d}.warc")
            yield pd.DataFrame({"file": [f"{folder}/part-{part:06d}.warc"], "size": [size], "records": [n]})

    # Ids travel as text: pandas makes doubles of longs beside a null.
    rows = with_responses(pages).withColumns({c: F.col(c).cast("string") for c in ("page_id", "_to")})
    files = rows.mapInPandas(write, "file string, size long, records long")
    return sorted((r.asDict() for r in files.collect()), key=lambda r: r["file"])


def read_header(source, at: int) -> tuple[dict[str, str], int] | None:
    """Header fields of the record at ``at`` and the offset of its block."""
    source.seek(at)
    data = source.read(STEP)
    if not data.startswith(MAGIC):
        return None
    looked = 0
    while (end := data.find(END, max(0, looked - 3))) < 0:
        looked = len(data)
        more = source.read(STEP)
        if not more:
            return None
        data += more
    fields = {}
    for line in data[len(MAGIC):end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon:
            fields.setdefault(name.decode("latin-1").strip().lower(), value.decode("utf-8", "replace").strip())
    return fields, at + end + len(END)


def successor(source, at: int) -> int | None:
    found = read_header(source, at)
    if found is None or not re.fullmatch(r"\d+", found[0].get("content-length", "")):
        return None
    return found[1] + int(found[0]["content-length"]) + len(END)


def candidates(source, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets in [start, end) that look like records, and where each one's
    chain leaves the range (pointer jumping within the range)."""
    at: list[int] = []
    lap = len(MAGIC) - 1
    place = start
    while place < end:
        source.seek(place)
        data = source.read(min(RANGE, end - place) + lap)
        i = data.find(MAGIC)
        while 0 <= i and place + i < end:
            if not at or place + i > at[-1]:
                at.append(place + i)
            i = data.find(MAGIC, i + 1)
        place += RANGE
    pairs = [(a, s) for a in at if (s := successor(source, a)) is not None]
    if not pairs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    own, out = np.array(pairs, np.int64).T.copy()
    while True:  # successors lie behind, so chains inside the range end
        i = np.minimum(np.searchsorted(own, out), len(own) - 1)
        go = own[i] == out
        if not go.any():
            return own, out
        out = np.where(go, out[i], out)


def ranges_of(files: list[dict], size: int) -> list[tuple[int, int, int]]:
    return [(k, a, min(a + size, f["size"])) for k, f in enumerate(files) for a in range(0, f["size"], size)]


def chain_starts(spark: SparkSession, files: list[dict], size: int = RANGE) -> DataFrame:
    """(file, at, beyond): for every range the first record that a chain from
    the file's start reaches, and where the chain leaves the range."""
    prepare_python(spark)
    names, cuts = [f["file"] for f in files], ranges_of(files, size)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs
        for batch in batches:
            for r in batch["id"]:
                k, start, end = cuts[r]
                store, path = fs.FileSystem.from_uri(names[k])
                with store.open_input_file(path) as source:
                    at, beyond = candidates(source, start, end)
                yield pd.DataFrame({"file": np.full(len(at), k, np.int64), "at": at, "beyond": beyond,
                                    "next": beyond, "reached": at == 0})

    schema = "file long, at long, beyond long, next long, reached boolean"
    state = saved(spark.range(0, len(cuts), 1, max(1, len(cuts))).mapInPandas(scan, schema), "warc-chain")
    longest = max([0, *(-(-f["size"] // size) for f in files)])
    for _ in range(max(0, longest - 1).bit_length()):  # chains of `longest` ranges
        push = state.filter("reached").select("file", F.col("next").alias("at"), F.lit(True).alias("_hit"))
        jump = state.select("file", F.col("at").alias("next"), F.col("next").alias("_next"))
        state = saved(state.join(push.distinct(), ["file", "at"], "left").join(jump, ["file", "next"], "left")
                      .select("file", "at", "beyond", F.coalesce("_next", "next").alias("next"),
                              (F.col("reached") | F.coalesce("_hit", F.lit(False))).alias("reached")), "warc-chain")
    return state.filter("reached").select("file", "at", "beyond")


def read_archives(spark: SparkSession, files: list[dict], size: int = RANGE, with_payload: bool = False) -> DataFrame:
    """Verified records: page_id, record_type, payload_bytes (null for
    revisits), payload_digest, refers_to (and payload)."""
    names = [f["file"] for f in files]
    starts = chain_starts(spark, files, size)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs
        for batch in batches:
            for k, at, beyond in zip(batch["file"], batch["at"], batch["beyond"]):
                store, path = fs.FileSystem.from_uri(names[k])
                rows = []
                with store.open_input_file(path) as source:
                    while at < beyond:
                        fields, body = read_header(source, at)
                        length = int(fields["content-length"])
                        source.seek(body)
                        payload = source.read(length).partition(END)[2]
                        kind = fields["warc-type"]
                        digest = fields["warc-payload-digest"].removeprefix("sha1:")
                        if kind == "response" and digest32(payload) != digest:
                            raise ValueError(f"payload digest differs at {path}:{at}")
                        rows.append((page_of(fields["warc-record-id"]), kind,
                                     len(payload) if kind == "response" else None, digest,
                                     page_of(fields.get("warc-refers-to")))
                                    + ((payload,) if with_payload else ()))
                        at = body + length + len(END)
                        if len(rows) == 500:
                            yield frame(rows)
                            rows = []
                yield frame(rows)

    cols = ["page_id", "record_type", "payload_bytes", "payload_digest", "refers_to"] + ["payload"] * with_payload

    def frame(rows: list) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=cols).astype({"payload_bytes": "Int64"})

    schema = ("page_id string, record_type string, payload_bytes long, payload_digest string, refers_to string"
              + ", payload binary" * with_payload)
    n = max(1, len(ranges_of(files, size)))
    found = starts.repartition(n, "file", "at").mapInPandas(read, schema)
    return found.withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})


def resolved(records: DataFrame) -> DataFrame:
    """Revisits with the payload length of the response they refer to. Read
    twice: pass a written table."""
    sizes = (records.filter("record_type = 'response'")
             .groupBy(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest"))
             .agg(F.max("payload_bytes").alias("_bytes")))
    to = F.coalesce("refers_to", F.lit(None))
    return (records.join(sizes, (to == sizes["_id"]) & (records["payload_digest"] == sizes["_digest"]), "left")
            .withColumn("payload_bytes", F.coalesce("payload_bytes", "_bytes")).drop("_id", "_digest", "_bytes"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: every page's record, written and read back."""
    files = write_archives(table(spark, sf_dir, "pages"), shared_path(spark, "warc"))
    return resolved(saved(read_archives(spark, files), "warc-records")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
