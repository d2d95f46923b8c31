"""WARC derivatives: linked identifiers, digests, text, files."""

import gzip
import hashlib
import re
import uuid

from ticklake.llm import warc

SCHEMA = "page_id long, url string, html string, record string"
HTML = ('<!DOCTYPE html><html lang="en"><head><title>A &amp;\n B</title><style>p{}</style><script>var t="</p>";</script>'
        '</head><body><!-- no --><p>One <b>two</b>&nbsp;&lt;x&gt;<br>three</p><a href="/q?a=1&amp;b=2">link</a></body></html>')


def test_records(frame):
    rows = warc.derive(warc.responses(frame([(1, "http://e.com/x", HTML, "clash")], SCHEMA))).collect()
    meta, text = sorted(rows, key=lambda r: r["kind"], reverse=True)
    assert text["block"] == "A &\nB\nOne two <x>\nthree\nlink"
    assert "title: A & B\r\n" in meta["block"] and "outlink: /q?a=1&b=2\r\n" in meta["block"]
    assert "language: en\r\n" in meta["block"] and "http-status: 200\r\n" in meta["block"]
    assert text["refers_to"] == meta["refers_to"] and text["record_id"] != meta["record_id"]
    for r in rows:
        uuid.UUID(r["record_id"][10:-1])
        head, _, body = r["record"].partition("\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.split("\r\n")[1:])
        assert head.startswith("WARC/1.1\r\n") and body == r["block"]
        assert fields["WARC-Refers-To"] == r["refers_to"] and fields["WARC-Target-URI"] == "http://e.com/x"
        assert fields["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(body.encode()).hexdigest()
        assert int(fields["Content-Length"]) == len(body.encode()) == r["n_bytes"]
    assert meta["payload_digest"] == "sha256:" + hashlib.sha256(HTML.encode()).hexdigest()


def test_every_source_header_is_kept(frame):
    heads = ("HTTP/1.1 301 Moved\r\nServer: x/1\r\nDate: Sat, 01 Jan 2000 00:00:00 GMT\r\nSet-Cookie: a=1\r\n"
             "Content-Type: text/html\r\nset-cookie:b=2; at=10:30\r\nX-Long: one\r\n  two\r\nno header\r\n"
             "Content-Length: 0\r\nLocation: http://e.com/y\r\n\r\n")
    schema = "source_id long, record_id string, target_uri string, date string, http_headers string, payload string"
    rows = [(1, "<urn:uuid:1>", "u", "2000-01-01T00:00:00Z", heads, ""), (2, "<urn:uuid:2>", "u", "d", None, None)]
    got = {r["source_id"]: r["block"] for r in warc.derive(frame(rows, schema)).collect() if r["kind"] == "metadata"}
    assert got[1].split("\r\ntitle: ")[0].split("\r\n") == [
        "http-status: 301", "http-server: x/1", "http-date: Sat, 01 Jan 2000 00:00:00 GMT", "http-set-cookie: a=1",
        "http-content-type: text/html", "http-set-cookie: b=2; at=10:30", "http-x-long: one two",
        "http-malformed: no header", "http-content-length: 0", "http-location: http://e.com/y"]
    assert got[2].startswith("http-status: \r\ntitle: \r\n")


def test_links_in_any_quoting_and_all_references(frame):
    page = ("<title>&Eacute;t&eacute; &#8211; &#x1F600;</title><p>Stra&szlig;e &uuml;&ntilde;&#233; &amp;eacute; &bogus; "
            "&#128; a&#160;b &#99999999999; &amp</p><a href='/one?a=1&amp;b=&eacute;'>1</a><a\nclass=x href=/two>2</a>"
            '<a data-href="/no" href = "/three">3</a><A HREF="/four" href="/no">4</A><a data-href="/no">5</a>'
            '<a title="a > b href=/no" href="\n /fi\nve ">6</a><a/href=/six/>7</a><abbr href="/no">8</abbr><a href="/open>9')
    got = {r["kind"]: r["block"] for r in warc.derive(warc.responses(frame([(1, "u", page, "")], SCHEMA))).collect()}
    assert re.findall("outlink: (.*)\r\n", got["metadata"]) == [
        "/one?a=1&b=é", "/two", "/three", "/four", "/five", "/six/"]
    assert "title: Été – 😀\r\n" in got["metadata"]
    assert "Straße üñé &eacute; &bogus; € a b \ufffd &amp\n" in got["conversion"]


def test_link_search_stays_linear():
    for h in ("<a " * 200_000, '<a href="' * 100_000, "<a href='" * 100_001, "<a " + "x='1' " * 100_000, "&" * 400_000,
              "<a" + " " * 400_000, "<a x" + " =" * 200_000, "&#" + "1" * 400_000 + ";"):
        warc.links_of(h)
        warc.decoded(h)


def test_odd_inputs(frame):
    rows = [(None, None, None, ""), (2, "u", "", ""), (2, "u", "", ""), (3, "u", "<p>a " * 50_000, ""),
            (4, "u", "<script>never closed", "")]
    got = warc.derive(warc.responses(frame(rows, SCHEMA))).collect()
    assert len(got) == 10 and all(r["block"] is not None and r["record"] for r in got)
    assert [r["block"] for r in got if r["source_id"] == 2 and r["kind"] == "conversion"] == ["", ""]
    assert not any("WARC-Target-URI" in r["record"] for r in got if r["source_id"] is None)
    assert warc.derive(warc.responses(frame([], SCHEMA))).count() == 0


def test_files(frame, tmp_path):
    got = warc.derive(warc.responses(frame([(i, f"http://e/{i}", HTML, "") for i in range(7)], SCHEMA)))
    warc.write_warc(got, str(tmp_path / "w"))
    data = b"".join(gzip.open(p).read() for p in sorted((tmp_path / "w").glob("*.gz")))
    n = 0
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert rest[size:size + 4] == b"\r\n\r\n"
        data, n = rest[size + 4:], n + 1
    assert n == 14


def test_unclosed_elements_are_read_once():
    import time

    from ticklake.llm.warc import links_of, page_text, shown
    for piece in ("<script>", "<script", "<!--", "<style>", "<a", "<p ", "<a href=x "):
        t = time.process_time()
        page_text(piece * 100_000), links_of(shown(piece * 100_000))
        assert time.process_time() - t < 5, piece
    assert page_text("a<!-- <a href=x>b</a> -->c<script>d</script>e<script>f") == "acef"
    assert page_text("x<p>y<br/>z<pre>w<pretty>v<P >u") == "x\ny\nz\nwv\nu"


def test_hidden_links_and_header_line_ends(frame):
    rows = [(1, "http://a/\r\nWARC-Type: evil", '<html lang="en\r\nX: y"><!-- <a href="no">--><script>"<a href=\'no\'>"</script>'
                                                '<a href="yes">t</a>')]
    from ticklake.llm import warc
    got = warc.derive(warc.responses(frame(rows, "page_id long, url string, html string"))).collect()
    for r in got:
        head, block = r.record.split("\r\n\r\n", 1)
        names = [line.split(":")[0] for line in head.split("\r\n")[1:]]
        assert names.count("WARC-Type") == 1 and "WARC-Target-URI: http://a/%0D%0AWARC-Type: evil" in head.split("\r\n")
        if r.kind == "metadata":
            assert [x for x in block.split("\r\n") if x.startswith("outlink")] == ["outlink: yes"]
            assert "language: en X: y" in block.split("\r\n")
