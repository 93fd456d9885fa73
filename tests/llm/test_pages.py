"""URL filters and archives."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
import re
from collections import Counter
from pathlib import Path

import pyarrow as pa
import pytest

from basketflow.llm import archives as ar
from basketflow.llm import url_filters as uf

URLS = [
    "http://EXAMPLE.net/en/1", "http://example.net/en", "http://a.b.example.net/en/x?y#z", "http://xexample.net/en/1",
    "https://net/", "https://net", "http://a.net", "http://a.net/x", "http://example.com/de/1", "http://www.example.com/DE/1",
    "http://a.org/fr/", "http://org/fr/x", "http://casino-win.example.com/en/1", "http://CASINO.example.com/", "http://cassino.com/",
    "http://free-bets.x.com", "http://bets-free.x.com", "http://x.com/ads/a.js?q", "http://x.com/ads/a.jsx", "no url", "", None,
    "://", "a://b://c/d", "http://h?q=/x", "http://h#f/x", "http://x.com/?clickid=1&aff_id=2", "http://x.com/?click_id=1&z=3&affiliateid=2",
    "http://é.net/É/", "HTTP://X.NET:80/p", "http://u@x.net/p/q/?r", "http://a.net/" + "x" * 50_000, "http://a\nb.net/c",
]


def brute(url, counts=None):
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        ends = [rest.find(c) for c in "/?#" if c in rest]
        host = lower(rest[: min(ends)] if ends else rest)
        rest = rest[len(host) :]
        ends = [rest.find(c) for c in "?#" if c in rest]
        path = rest[: min(ends)] if ends else rest
    best = None
    for rule in uf.HOST_RULES:
        own, slash, start = rule.rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith(slash + start):
            if best is None or len(rule.rule) > len(best.rule):
                best = rule
    if best:
        return host, path, best.rule, best.verdict
    hit = any(re.search(r.pattern, lower(url or "")) for r in uf.PATTERN_RULES)
    return host, path, None, "block" if hit else "allow"


def test_urls(spark):
    rows = [(i, u, "x", "y") for i, u in enumerate(URLS)] + [(None, URLS[0], "x", "y"), (0, URLS[0], "x", "y")]
    pages = spark.createDataFrame(rows, "page_id BIGINT, url STRING, host STRING, verdict STRING")
    found = Counter(tuple(r) for r in uf.judge_urls(pages).collect())
    assert found == Counter((i, *brute(u)) for i, u, _, _ in rows)
    assert uf.judge_urls(pages.limit(0)).count() == 0


def test_rules_are_filed_under_their_rarest_token(spark):
    pages = spark.createDataFrame([("http://free.x/free",)] * 5 + [("http://bets.x",)], "url STRING")
    counts = uf.token_counts(pages, ["bets", "free", "none"])
    assert counts == {"free": 5, "bets": 1, "none": 0}
    rules = (uf.PatternRule("/free/bets/"), uf.PatternRule(r"[.]free-none[.]"), uf.PatternRule("c", ()))
    assert uf.index(rules, counts) == {"bets": [0], "none": [1], "": [2]}


def test_only_fetched_rules_run():
    rules = tuple(uf.PatternRule(f"[./]t{i}[./]") for i in range(500))
    judge = uf.Judge((), rules, uf.index(rules, {}))
    ran = []
    judge.compiled = {n: type("P", (), {"search": lambda self, u, n=n: ran.append(n)})() for n in judge.compiled}
    assert judge.by_pattern("http://a.t7.com/t9/x") == "allow"
    assert sorted(ran) == [7, 9]


def test_priority_decides():
    rules = (uf.PatternRule("ads"), uf.PatternRule("good", None, "allow"), uf.PatternRule("bad", (), "block", 1))
    judge = uf.Judge((), rules, uf.index(rules, {}))
    assert [judge.by_pattern(u) for u in ("x ads", "ads good", "ads good bad", "x")] == ["block", "allow", "block", "allow"]


@pytest.mark.parametrize(
    ("pattern", "tokens"),
    [
        (r"://([^/?#]*[.-])?casino[.-]", ("casino",)),
        (r"://([^/?#]*[.-])?free-bets[.-]", ("free", "bets")),
        ("casino", ()),
        ("/ads/", ("ads",)),
        (r"[/x]ads/", ()),
        (r"/ads[^?#]", ()),
        (r"^a/b$", ("a", "b")),
        (r"(?:-|_)ad(?:[/?]|$)", ("ad",)),
        (r"(?:-|q)ad/", ()),
        (r"/a(b)?/", ()),
        (r"/ad-?s/", ()),
        (r"/ad-+s/", ("ad", "s")),
        (r"[?&]click_?id=", ()),
        (r"-é-x-", ("x",)),
        (r"a|/b/", ()),
    ],
)
def test_tokens_are_those_that_every_match_holds(pattern, tokens):
    assert uf.implied_tokens(pattern) == tokens
    with pytest.raises(ValueError, match="does not imply"):
        uf.PatternRule(pattern, ("other",))


def test_rules_of_the_list_name_tokens_that_they_imply():
    for rule in uf.PATTERN_RULES:
        assert set(rule.tokens) <= set(uf.implied_tokens(rule.pattern))


def test_thousands_of_listed_rules(spark, tmp_path):
    """Fetched by token they give what running all of them gives."""
    rng = random.Random(17)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randrange(2, 4)))
    shapes = ["||{0}.{1}^", "/{0}/{1}/x", "-{0}-*{1}|", "|http://{0}.", "@@||{0}.{1}^{2}", ".{0}?", "q{0}q", "^{0}^{1}^", "@@/{0}.{1}|"]
    lines = ["! a comment", "[Heading]", "", *(rng.choice(shapes).format(word(), word(), word()) for _ in range(3000))]
    (tmp_path / "list.txt").write_text("\n".join(lines))
    rules = uf.read_rules(spark, str(tmp_path))
    assert len(rules) == 3000 and sum(bool(r.tokens) for r in rules) > 1500
    join = lambda: rng.choice("./-?_&=")
    urls = ["http://" + "".join(word() + join() for _ in range(rng.randrange(1, 7))) for _ in range(400)]
    counts = {}
    judge, plain = uf.Judge((), rules, uf.index(rules, counts)), [re.compile(r.pattern) for r in rules]
    verdicts = Counter()
    for url in urls:
        hits = [r for r, p in zip(rules, plain) if p.search(url)]
        expected = max(hits, key=lambda r: (r.priority, r.verdict == "allow")).verdict if hits else "allow"
        assert judge.by_pattern(url) == expected, url
        verdicts[expected] += 1
    assert min(verdicts.values()) > 20
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id BIGINT, url STRING")
    found = {r.page_id: r.verdict for r in uf.judge_urls(pages, (), rules).collect()}
    assert found == {i: judge.by_pattern(u) for i, u in enumerate(urls)}
    for line in ("||x.com^$third-party", "/regex/", "x.com##.ad"):
        with pytest.raises(ValueError, match="no rule of this kind"):
            uf.listed_rule(line)


def test_too_many_rules(spark):
    pages = spark.createDataFrame([(1, "http://x")], "page_id BIGINT, url STRING")
    with pytest.raises(ValueError, match="more than"):
        uf.judge_urls(pages, rules=(uf.PatternRule("a"),) * (uf.MAX_RULES + 1))


# --- archives -----------------------------------------------------------------


def test_arc_of_both_versions():
    records = [
        ("http://a.b/c", "20240102030405", b"HTTP/1.1 200 OK\r\n\r\nbody\n\n"),
        ("http://ä.b/x y", "20240102030405", b""),
        ("-", "200001020304", b"\n\nhttp://x 1 2 3 4\n"),
    ]
    for version in (1, 2):
        archive = ar.arc_archive(records, version)
        found = list(ar.parse_arc(archive))
        assert [r.content for r in found] == [c for _, _, c in records]
        assert found[1].fields["URL"] == "http://%C3%A4.b/x%20y"
        assert [r.fields["Archive-date"] for r in found] == [d for _, d, _ in records]
        assert list(found[0].fields) == ar.ARC_FIELDS[version]
        with pytest.raises(ValueError, match="declared"):
            list(ar.parse_arc(archive[:-3]))
    with pytest.raises(ValueError, match="version"):
        list(ar.parse_arc(archive.replace(b"\n2 0 ", b"\n9 0 ")))
    with pytest.raises(ValueError, match="fields"):
        list(ar.parse_arc(ar.arc_archive([], 1) + b"http://x text/html 0\n"))
    assert ar.iso_date("20240102030405") == "2024-01-02T03:04:05Z"


def test_warc_of_a_record():
    arc = ar.ArcRecord({"URL": "http://x/", "IP-address": "1.2.3.4", "Archive-date": "20240102030405", "Content-type": "text/html"},
                       ar.http_response(7, "é\r\n\r\nWARC/1.1\r\n"))
    first, again = ar.warc_record(arc, None), ar.warc_record(arc, 3)
    assert first == ar.warc_record(arc, None)  # a task that is run again
    archive = b"".join(r + b"\r\n\r\n" for r in (first, again))
    one, two = ar.parse_warc(archive)
    payload = "é\r\n\r\nWARC/1.1\r\n".encode()
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    assert one.payload == payload and one.headers["WARC-Payload-Digest"] == f"sha1:{digest}"
    assert one.headers["WARC-Date"] == "2024-01-02T03:04:05Z" and one.headers["WARC-IP-Address"] == "1.2.3.4"
    assert two.payload == b"" and two.headers["WARC-Type"] == "revisit"
    assert two.headers["WARC-Payload-Digest"] == f"sha1:{digest}"
    assert two.headers["WARC-Refers-To"] == ar.record_id(3, digest)
    with pytest.raises(ValueError):
        list(ar.parse_warc(archive.replace("é".encode(), b"ee")))
    with pytest.raises(ValueError):
        list(ar.parse_warc(archive[:-4]))


def test_through_archives(spark):
    rng = random.Random(1)
    html = lambda: "".join(rng.choice(["<p>", "\r\n\r\n", "WARC/1.1\r\n", "é", "\n", "x", "\x00", "漢"]) for _ in range(rng.randrange(30)))
    rows = [(i, f"http://h{i}.net/ä b?{i}", html()) for i in range(150)]
    rows += [(200 + i, "http://copy", rows[i % 3][2]) for i in range(60)]
    rows += [(300, None, None), (301, "u", ""), (302, "u", "x" * 300_000), (303, "u", "x" * 300_000), (5, rows[5][1], rows[5][2])]
    rows += [(None, "u", rows[0][2]), (None, "u", "only here")]
    rng.shuffle(rows)
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id BIGINT, url STRING, html STRING, first_id INT").repartition(3)
    for least in (0, 4, 10**9):
        first = {}
        for i, _, h in rows:
            if i is not None:
                first[h or ""] = min(i, first.get(h or "", i))
        expected = Counter()
        for i, _, h in rows:
            payload = (h or "").encode()
            own = first.get(h or "")
            copies = sum((x or "") == (h or "") for _, _, x in rows) > 1
            revisit = own is not None and i != own and len(payload) >= least and copies
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            expected[i, len(payload), digest, "revisit" if revisit else "response", own if revisit else None] += 1
        assert Counter(tuple(r) for r in ar.through_archives(pages, least).collect()) == expected
    assert ar.through_archives(pages.limit(0)).count() == 0


def arc_record(i: int, body: bytes) -> ar.ArcRecord:
    fields = {"URL": f"http://{i}", "IP-address": "0", "Archive-date": "20240101000000", "Content-type": "text/html"}
    return ar.ArcRecord(fields, ar.http_response(i, body.decode()))


def test_files_are_bounded_and_come_back(spark, tmp_path):
    """Files hold so many bytes, a larger record has one of its own, and batches are small."""
    sizes = [100] * 60 + [50_000] + [3_000] * 40
    records = [(ar.warc_record(arc_record(i, b"x" * n), None),) for i, n in enumerate(sizes)]
    ar.write_warc(spark.createDataFrame(records, "record BINARY").coalesce(1), str(tmp_path / "w"), file_bytes=20_000)
    files = [f.stat().st_size for f in (tmp_path / "w").rglob("part-*")]
    assert len(files) > 8 and sorted(files)[-2] <= 20_010 and max(files) < 51_000
    found = ar.read_warc(spark, str(tmp_path / "w")).collect()
    assert {(r.page_id, len(r.payload), r.uri, r.date) for r in found} == {
        (i, n, f"http://{i}", "2024-01-01T00:00:00Z") for i, n in enumerate(sizes)
    }


def test_rows_are_handed_on_in_small_batches(monkeypatch):
    monkeypatch.setattr(ar, "BATCH_BYTES", 10_000)
    rows = ({"n": i, "payload": b"x" * 3_000} for i in range(50))
    schema = pa.schema([("n", pa.int64()), ("payload", pa.binary())])
    batches = list(ar.in_batches(rows, schema, lambda r: len(r["payload"])))
    assert [b.num_rows for b in batches] == [4] * 12 + [2]
    assert [n for b in batches for n in b.column("n").to_pylist()] == list(range(50))


def test_long_pages(spark):
    """300 pages of 1 MB: many files, each bounded."""
    pages = spark.range(300).selectExpr("id AS page_id", "concat('http://a/', id) AS url", "repeat(concat('<p>', id, ' '), 160000) AS html")
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("warc-*"))
    found = ar.through_archives(pages).collect()
    assert {r.page_id: r.payload_bytes for r in found} == {i: 160_000 * len(f"<p>{i} ") for i in range(300)}
    assert {r.record_type for r in found} == {"response"}
    files = [f.stat().st_size for new in set(shared.glob("warc-*")) - before for f in new.rglob("part-*")]
    assert max(files) <= ar.FILE_BYTES + 4 and sum(files) > 250_000_000


# --- legacy archives from storage ----------------------------------------------


def line(url, kind, content, version=1, declared=None) -> bytes:
    middle = b"" if version == 1 else b" 200 - - 0 a file.arc"
    length = len(content) if declared is None else declared
    return b"%s 1.2.3.4 20240102030405 %s%s %d\n%s\n" % (url, kind, middle, length, content)


def version_block(version: int) -> bytes:
    block = f"{version} 0 Somebody\n{' '.join(ar.ARC_FIELDS[version])}\n".encode()
    return line(b"filedesc://a.arc", b"text/plain", block)


@pytest.mark.parametrize("version", [1, 2])
def test_blanks_inside_fields(version):
    archive = version_block(version) + line(b"http://a/b c d", b"text/html; charset=utf-8", b"one", version)
    (found,) = ar.scan_arc(archive)
    assert (found.fields["URL"], found.fields["Content-type"]) == ("http://a/b c d", "text/html; charset=utf-8")
    assert found.content == b"one"


def test_bad_records_have_rows_of_their_own():
    good = [line(b"http://a/%d" % i, b"text/html", b"body %d" % i) for i in range(4)]
    archive = version_block(1) + good[0]
    first_bad = len(archive)
    archive += b"no record line at all\n" + good[1]
    second_bad = len(archive)
    archive += line(b"http://wrong/", b"text/html", b"too short", declared=2) + good[2]
    third_bad = len(archive)
    archive += line(b"http://cut/", b"text/html", b"x", declared=10_000) + good[3]
    found = list(ar.scan_arc(archive))
    assert [r.content for r in found if isinstance(r, ar.ArcRecord)] == [b"body %d" % i for i in range(4)]
    assert [r.at for r in found if isinstance(r, ar.BadRecord)] == [first_bad, second_bad, third_bad]
    assert [type(r) for r in ar.scan_arc(b"")] == [ar.BadRecord]


def test_compressed_and_damaged_archives_from_storage(spark, tmp_path):
    plain = [version_block(1), *(line(b"http://a/%d" % i, b"text/html", b"body %d" % i) for i in range(20))]
    (tmp_path / "a.arc").write_bytes(b"".join(plain))
    (tmp_path / "b.arc.gz").write_bytes(b"".join(map(gzip.compress, plain)))
    (tmp_path / "c.arc.gz").write_bytes(b"".join(map(gzip.compress, plain))[:-9])
    (tmp_path / "d.arc").write_bytes(b"something else\n")
    (tmp_path / "e.txt").write_bytes(b"no archive")
    rows = ar.read_arc(spark, str(tmp_path)).collect()
    read = Counter((Path(r.file).name, r.error is None) for r in rows)
    assert read == {
        ("a.arc", True): 20, ("b.arc.gz", True): 20, ("c.arc.gz", True): 19, ("c.arc.gz", False): 1, ("d.arc", False): 1
    }
    assert {(r.url, bytes(r.content), r.date) for r in rows if r.file.endswith("b.arc.gz")} == {
        (f"http://a/{i}", b"body %d" % i, "2024-01-02T03:04:05Z") for i in range(20)
    }
    assert "cut" in next(r.error for r in rows if r.file.endswith("c.arc.gz") and r.error)
