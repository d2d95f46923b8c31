"""WARC derivatives: metadata and plain-text conversion records of responses.

``derive`` takes response records (identifier, target URI, date, HTTP header
block, payload) and gives two records for each: a *metadata* record
(application/warc-fields: status and every source header, title, language,
payload digest, out-links) and a *conversion* record (text/plain).  Both carry the
response's identifier in WARC-Refers-To, its target URI and date, and their
own block digest; the conversion also names the response's payload digest.
Identifiers are derived from the response's, so a repeated run gives the
same records (a repeated response gives repeated records).

Text: comments, scripts and styles go, block tags become line ends, other
tags go, references (numeric, and every name of HTML; one without its
semicolon stays, as in the SQL) are decoded, white space is folded.  An element
that is never closed is treated as its tags alone.  Out-links are the href of
each <a> in any quoting.

``record`` is the whole record (headers, empty line, block); ``write_warc``
writes records as gzipped WARC files.  ``responses`` makes response records
of a table of pages.  A null payload counts as empty; a null URI leaves out
WARC-Target-URI.  Everything is one pass without a shuffle.
"""

from __future__ import annotations

import re
from html import unescape
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"
BLOCK_TAGS = ("p|br|div|li|ul|ol|h1|h2|h3|h4|h5|h6|article|section|nav|footer|header|main|table|tr|title|head|body|"
              "html|blockquote|pre")
REFERENCE = re.compile(r"&(#[0-9]++|#[xX][0-9a-fA-F]++|[A-Za-z][A-Za-z0-9]*+);")
LINK_TAG = re.compile(r"<a(?=[\s/])", re.IGNORECASE)
ATTRIBUTE = re.compile(r"""[\s/]*+([^\s/>=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|((?!["'])[^\s>]++)))?+""")
URL_EDGE = "".join(map(chr, range(33)))


def urn(name: Column) -> Column:
    """<urn:uuid:...> from the md5 of a name."""
    h = F.md5(name.cast("binary"))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-"), part(13, 4), F.lit("-"),
                    part(17, 4), F.lit("-"), part(21, 12), F.lit(">"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def replace_all(text: Column, pattern: str, by: str) -> Column:
    return F.regexp_replace(text, F.lit(pattern), F.lit(by))


def character(found: re.Match) -> str:
    """What a reference stands for; an unknown name stays."""
    name = found[1]
    if name[0] != "#":
        out = html5.get(name + ";", found[0])
    else:
        base = "x" if name[1] in "xX" else ""
        number = name[1 + len(base):].lstrip("0") or "0"
        out = unescape(f"&#{base}{number};") if len(number) <= 7 else "\ufffd"
    return " " if out == "\xa0" else out


def decoded(text: str) -> str:
    return REFERENCE.sub(character, text) if "&" in text else text


def links_of(html: str) -> list[str]:
    """The first href of each <a>, in any quoting, as a URL: decoded, without
    line ends and tabs, and without white space at its ends."""
    out, tag = [], LINK_TAG.search(html)
    while tag:
        at, link = tag.end(), None
        while part := ATTRIBUTE.match(html, at):
            at = part.end()
            if link is None and part[1].lower() == "href":
                link = next((v for v in part.groups()[1:] if v is not None), None)
        if link is not None:
            out.append(re.sub("[\t\r\n]", "", decoded(link).strip(URL_EDGE)))
        tag = LINK_TAG.search(html, at)
    return out


def without(html: str, opener: re.Pattern, closer: re.Pattern, by: str = "") -> str:
    """The text without each stretch from an opener to the next closer; an
    opener that no closer follows stays, and so do all after it (one pass)."""
    out, at = [], 0
    while (start := opener.search(html, at)) and (end := closer.search(html, start.end())):
        out += [html[at:start.start()], by]
        at = end.end()
    return "".join([*out, html[at:]])


ASCII = re.IGNORECASE | re.ASCII
COMMENT, COMMENT_END = re.compile("<!--"), re.compile("-->")
SCRIPT, SCRIPT_END = re.compile("<script", ASCII), re.compile("</script>", ASCII)
STYLE, STYLE_END = re.compile("<style", ASCII), re.compile("</style>", ASCII)
BLOCK_TAG, TAG = re.compile(f"</?(?:{BLOCK_TAGS})(?=/?>| )", ASCII), re.compile("<[a-zA-Z/!]")
TAG_END = re.compile(">")


def shown(html: str) -> str:
    """The page without comments, scripts and styles."""
    html = without(html, COMMENT, COMMENT_END)
    # an element ends at the first closer after its own opening tag
    for opener, closer in ((SCRIPT, SCRIPT_END), (STYLE, STYLE_END)):
        out, at = [], 0
        while (start := opener.search(html, at)) and (tag := TAG_END.search(html, start.end())) and (
                end := closer.search(html, tag.end())):
            out.append(html[at:start.start()])
            at = end.end()
        html = "".join([*out, html[at:]])
    return html


def page_text(html: str) -> str:
    """Text without tags (block tags end a line), references decoded."""
    return decoded(without(without(shown(html), BLOCK_TAG, TAG_END, "\n"), TAG, TAG_END))


def decode_references(text: Column) -> Column:
    @F.arrow_udf("string")
    def decode(texts: pa.Array) -> pa.Array:
        return pa.array([t and decoded(t) for t in texts.to_pylist()], pa.string())

    return decode(text)


PAGE = pa.struct([("links", pa.list_(pa.string())), ("text", pa.string())])


def page_parts(html: Column) -> Column:
    """struct(links, text) of a page."""
    @F.arrow_udf("links array<string>, text string")
    def parts(pages: pa.Array) -> pa.Array:
        return pa.array([{"links": links_of(shown(h or "")), "text": page_text(h or "")} for h in pages.to_pylist()], PAGE)

    return parts(html)


def one_line(text: Column) -> Column:
    """A header value: a line end in it would begin another header."""
    return replace_all(text, "[\\r\\n]+", " ")


def uri(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def folded(text: Column) -> Column:
    """White space runs as one space or line end, none at the ends; what is
    one already is no match."""
    text = replace_all(text, "[\\t\\r][ \\t\\r]*| [ \\t\\r]+", " ")
    text = replace_all(text, " \\n[ \\n]*|\\n[ \\n]+", "\n")
    return F.trim(F.btrim(text, F.lit("\n")))


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Response records of crawled pages, which hold no headers of their own:
    a status line and a Content-Type stand in for them."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    name = F.concat(F.lit("response:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"),
                    F.coalesce(F.col(url_col), F.lit("")))
    return pages.select(
        F.col(id_col).alias("source_id"), urn(name).alias("record_id"), F.col(url_col).alias("target_uri"),
        F.lit(date).alias("date"),
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}").alias("http_headers"),
        html.alias("payload"))


def header_fields(heads: Column) -> Column:
    """Every header of a block as a field http-<name in lower case>, in order,
    repeats included; folded lines are joined, a line that is no header goes to
    http-malformed."""
    lines = F.filter(F.split(replace_all(heads, "\\r?\\n[ \\t]+", " "), "\\r\\n|\\r|\\n"),
                     lambda x, i: (x != "") & ~((i == 0) & x.startswith("HTTP/")))

    def field(x: Column) -> Column:
        colon = F.instr(x, ":")
        name = F.trim(F.substring(x, F.lit(1), colon - 1))
        return F.concat(F.lit("http-"), F.when(name != "", F.lower(name)).otherwise("malformed"), F.lit(": "),
                        F.trim(F.when(name != "", F.substring(x, colon + 1, F.length(x))).otherwise(x)), F.lit(CRLF))

    return F.array_join(F.transform(lines, field), "")


def derive(rows: DataFrame) -> DataFrame:
    """source_id, kind, record_id, refers_to, target_uri, payload_digest,
    block_digest, n_bytes, block, record: two rows per response."""
    html, heads = F.coalesce(F.col("payload"), F.lit("")), F.coalesce(F.col("http_headers"), F.lit(""))
    found = rows.select(
        "source_id", F.col("record_id").alias("refers_to"), "target_uri", "date", heads.alias("heads"),
        digest(html).alias("payload_digest"),
        F.regexp_extract(html, '(?i)<html[^>]* lang="([^"]*)"', 1).alias("language"),
        decode_references(F.regexp_extract(html, "(?i)<title[^>]*>([^<]*)", 1)).alias("title"),
        page_parts(html).alias("page"))
    found = found.select("*", "page.links", "page.text")
    fields = F.concat(
        F.lit("http-status: "), F.regexp_extract("heads", "^HTTP/[0-9.]+ ([0-9]+)", 1), F.lit(CRLF),
        header_fields(F.col("heads")),
        F.lit("title: "), F.trim(replace_all(F.col("title"), "[ \\t\\r\\n]+", " ")), F.lit(CRLF),
        F.lit("language: "), one_line(F.col("language")), F.lit(CRLF),
        F.lit("payload-digest: "), F.col("payload_digest"), F.lit(CRLF),
        F.array_join(F.transform("links", lambda x: F.concat(F.lit("outlink: "), x, F.lit(CRLF))), ""))
    both = F.array(F.struct(F.lit("metadata").alias("kind"), fields.alias("block")),
                   F.struct(F.lit("conversion").alias("kind"), folded(F.col("text")).alias("block")))
    out = found.select("source_id", "refers_to", "target_uri", "date", "payload_digest",
                       F.explode(both).alias("r")).select(
        "source_id", "r.kind", urn(F.concat("r.kind", F.lit(":"), "refers_to")).alias("record_id"), "refers_to",
        "target_uri", "date", "payload_digest", digest(F.col("r.block")).alias("block_digest"),
        F.octet_length("r.block").cast("long").alias("n_bytes"), "r.block")
    header = lambda name, value: F.concat(F.lit(f"{name}: "), one_line(value), F.lit(CRLF))
    is_text = F.col("kind") == "conversion"
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), header("WARC-Type", F.col("kind")), header("WARC-Record-ID", F.col("record_id")),
        header("WARC-Refers-To", F.col("refers_to")),
        F.coalesce(header("WARC-Target-URI", uri(F.col("target_uri"))), F.lit("")), header("WARC-Date", F.col("date")),
        F.when(is_text, header("WARC-Refers-To-Payload-Digest", F.col("payload_digest"))).otherwise(""),
        header("WARC-Block-Digest", F.col("block_digest")),
        header("Content-Type", F.when(is_text, "text/plain; charset=utf-8").otherwise("application/warc-fields")),
        header("Content-Length", F.col("n_bytes").cast("string")), F.lit(CRLF))
    return out.withColumn("record", F.concat(head, F.col("block"))).drop("date")


def write_warc(records: DataFrame, path: str) -> None:
    """Gzipped WARC files, one per partition: each record, two line ends."""
    (records.select("record").write.mode("overwrite").option("lineSep", CRLF * 2)
     .option("compression", "gzip").text(path))
