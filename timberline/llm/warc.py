"""WARC derivatives: metadata and plain-text conversion records of stored responses.

``responses`` makes response records of a table of pages, ``derive`` makes of each response one metadata and
one conversion record which name it in WARC-Refers-To, and ``write_warc`` stores records as WARC/1.1 text. There
is no shuffle: each response is converted where it is read.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A table of pages has no fetch time; a response needs some date.
NO_DATE = "1970-01-01T00:00:00Z"
CRLF = "\r\n"
END = "\r\n\r\n"

RAW = ("script", "style", "noscript", "template", "iframe", "textarea")
BLOCKS = frozenset(
    "address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head "
    "header hr html li main nav ol p pre section table tbody tfoot thead title tr ul".split()
)
CELLS = frozenset(("td", "th", "option"))

_TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*)")
_REST = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
_HREF = re.compile(r"""\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_LANG = re.compile(r"""\blang\s*=\s*["']?([A-Za-z0-9-]+)""", re.I)

SCHEMA = (
    "page_id long, record_type string, record_id string, refers_to string, target_uri string, warc_date string, "
    "content_type string, content_length long, block_digest string, source_payload_digest string, "
    "source_headers string, block string"
)
_FIELDS = [part.split()[0] for part in SCHEMA.split(", ")]
_ARROW = pa.schema([(part.split()[0], pa.int64() if part.endswith("long") else pa.string()) for part in SCHEMA.split(", ")])


def readable(page: str) -> tuple[str, str, str, list[str]]:
    """Text, title, language and links of a page, in one pass from the left.

    Comments and the content of scripts and styles go; blocks end lines; characters are unescaped; white
    space is one blank. A tag without an end, as in a page that was cut, ends the text.
    """
    out: list[str] = []
    links: list[str] = []
    title, lang, pos, size, quoted = "", "", 0, len(page), True
    title_at = None
    while pos < size:
        lt = page.find("<", pos)
        if lt < 0:
            out.append(page[pos:])
            break
        if lt > pos:
            out.append(page[pos:lt])
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            pos = size if end < 0 else end + 3
            continue
        tag = _TAG.match(page, lt)
        if tag is None:
            if page[lt + 1 : lt + 2] in ("!", "?", "/"):
                end = page.find(">", lt)
                pos = size if end < 0 else end + 1
            else:
                out.append("<")
                pos = lt + 1
            continue
        rest = _REST.match(page, tag.end()) if quoted else None
        if rest is None:
            # An open quote runs to the end; from here on tags end at the next bracket.
            quoted = False
            end = page.find(">", tag.end()) + 1
        else:
            end = rest.end()
        if not end:
            break
        name, closing = tag.group(2).lower(), tag.group(1)
        if name in _RAW_END and not closing and page[end - 2] != "/":
            stop = _RAW_END[name].search(page, end)
            pos = stop.end() if stop else size
            continue
        if name == "title":
            if closing and title_at is not None and not title:
                title = " ".join(html.unescape("".join(out[title_at:])).split())
            title_at = len(out) + 1 if not closing else None
        elif name == "a" and not closing:
            href = _HREF.search(page, tag.end(), end)
            if href:
                links.append(" ".join(html.unescape(href.group(1) or href.group(2) or href.group(3) or "").split()))
        elif name == "html" and not closing:
            found = _LANG.search(page, tag.end(), end)
            lang = found.group(1) if found else lang
        if name in BLOCKS:
            out.append("\n")
        elif name in CELLS:
            out.append(" ")
        pos = end
    text = html.unescape("".join(out))
    lines = (" ".join(line.split()) for line in text.split("\n"))
    return "\n".join(line for line in lines if line), title, lang, [link for link in links if link]


def digest(data: bytes) -> str:
    """Labelled digest as WARC files have it: SHA-1 in base 32."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _utf8(text: str) -> bytes:
    return text.encode("utf-8", "replace")


def records_of(page_id, record_id: str, uri, date: str, headers: str, payload: str) -> list[tuple]:
    """The metadata and the conversion record of one response."""
    source = digest(_utf8(payload))
    text, title, lang, links = readable(payload)
    ids = {kind: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind} of {record_id}')}>" for kind in ("metadata", "conversion")}
    fields = [("sourceRecord", record_id), ("conversionRecord", ids["conversion"]), ("sourcePayloadDigest", source)]
    fields += [("sourceHeader", line) for line in headers.split(CRLF) if line]
    fields += [("title", title)] * bool(title) + [("language", lang)] * bool(lang) + [("outlink", link) for link in links]
    made = (
        ("metadata", "application/warc-fields", "".join(f"{name}: {value}{CRLF}" for name, value in fields)),
        ("conversion", "text/plain; charset=utf-8", text),
    )
    rows = []
    for kind, content_type, block in made:
        data = _utf8(block)
        rows.append(
            (page_id, kind, ids[kind], record_id, uri, date, content_type, len(data), digest(data), source, headers, data.decode())
        )
    return rows


def responses(pages: DataFrame, date: str = NO_DATE) -> DataFrame:
    """``page_id, record_id, target_uri, warc_date, http_headers, payload`` of ``page_id, url, html``.

    The record id is made of id, address and content, so equal rows are the same record in every run.
    """
    size = F.coalesce(F.octet_length("html"), F.lit(0)).cast("string")
    key = F.md5(
        F.to_json(F.struct(F.col("page_id").alias("i"), F.col("url").alias("u"), F.sha2("html", 256).alias("d"))).cast("binary")
    )
    part = lambda start, length: F.substring(key, start, length)
    name = F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-3"), part(14, 3), F.lit("-8"), part(18, 3), F.lit("-"), part(21, 12))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.concat(F.lit("<urn:uuid:"), name, F.lit(">")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("warc_date"),
        F.concat(
            F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), size, F.lit(CRLF)
        ).alias("http_headers"),
        F.coalesce("html", F.lit("")).alias("payload"),
    )


def _derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple] = []
        held = 0
        for values in zip(*(column for column in batch.columns)):
            made = records_of(*(value.as_py() for value in values))
            rows += made
            held += sum(len(row[-1]) for row in made)
            if held > 4 << 20:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), _ARROW)], schema=_ARROW)


def derive(records: DataFrame) -> DataFrame:
    """Two rows for each response: its metadata record and its conversion record, as in ``SCHEMA``.

    ``refers_to`` is the response's record id and ``target_uri`` its address; ``source_headers`` keeps its header
    lines as they were and ``source_payload_digest`` the digest of its payload. A null payload is an empty one and
    gives an empty text; a null address stays null; a null id stays null; equal responses give equal records; an
    empty table gives an empty result; other columns are ignored. No text is cut.
    """
    return records.select(
        "page_id",
        "record_id",
        "target_uri",
        "warc_date",
        F.coalesce("http_headers", F.lit("")).alias("http_headers"),
        F.coalesce("payload", F.lit("")).alias("payload"),
    ).mapInArrow(_derive, SCHEMA)


def as_warc(derived: DataFrame) -> DataFrame:
    """``value``: header and block of each record, without the two line ends that close it."""

    def header(name: str, column) -> F.Column:
        one_line = F.regexp_replace(column.cast("string"), r"[\r\n]+", " ")
        return F.when(column.isNotNull(), F.concat(F.lit(f"{name}: "), one_line, F.lit(CRLF))).otherwise(F.lit(""))

    return derived.select(
        F.concat(
            F.lit(f"WARC/1.1{CRLF}"),
            header("WARC-Type", F.col("record_type")),
            header("WARC-Record-ID", F.col("record_id")),
            header("WARC-Refers-To", F.col("refers_to")),
            header("WARC-Target-URI", F.col("target_uri")),
            header("WARC-Date", F.col("warc_date")),
            header("WARC-Block-Digest", F.col("block_digest")),
            header("Content-Type", F.col("content_type")),
            header("Content-Length", F.col("content_length")),
            F.lit(CRLF),
            F.col("block"),
        ).alias("value")
    )


def write_warc(derived: DataFrame, path: str) -> None:
    """Store records as WARC/1.1 files below ``path``, one file for each partition."""
    as_warc(derived).write.option("lineSep", END).text(path)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(responses(spark.read.parquet(f"{sf_dir}/pages.parquet")))
