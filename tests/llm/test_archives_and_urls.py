from __future__ import annotations

import io
import zipfile
from hashlib import sha1
from math import sqrt

import pytest

from ledgerloom.llm import url_templates as U
from ledgerloom.llm import zip_warc as Z

PAGE_SCHEMA = "page_id long, url string, html string, digest string, refers_to long, size long"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 5, 6) for r in rows], PAGE_SCHEMA).repartition(3)


@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("preface", [b"", b"some other file first"])
def test_packages_are_zip_files_and_are_read_by_ranges(wide, preface):
    members = [("a", b"123"), ("b/ü", b""), (Z.ARCHIVE, bytes(range(256)) * 40)]
    data = Z.zip_package(members, zip64=wide)
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert z.testzip() is None and [(n, z.read(n)) for n in z.namelist()] == members
    data, read = preface + data, []

    def ranges(offset, length):
        read.append(length)
        return data[offset : offset + length]

    package = Z.ZipRanges(ranges, len(data))
    for name, content in members:
        start, length = package.begin(name)
        assert data[start : start + length] == content


def test_packages_of_others_with_comment_and_deflated_members():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("stored", b"hello")
        z.writestr("packed", b"x" * 999, zipfile.ZIP_DEFLATED)
        z.comment = b"PK\x05\x06 not the end"
    data = out.getvalue()
    package = Z.ZipRanges(lambda o, n: data[o : o + n], len(data))
    start, length = package.begin("stored")
    assert data[start : start + length] == b"hello" and "packed" not in package.members
    with pytest.raises(ValueError):
        Z.ZipRanges(lambda o, n: data[:40][o : o + n], 40)


def test_damaged_records_are_refused():
    record = Z.warc_record(1, "http://a/", b"payload", None, False)
    assert Z.parse_record(record)["payload"] == b"payload"
    for bad in (record[:-5], record.replace(b"payload", b"paYload"), b"x" + record):
        with pytest.raises(ValueError):
            Z.parse_record(bad)


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(Z, "PACKAGE_BYTES", 2000)
    large = "é\r\n\r\n" * 400
    rows = [(1, "http://a/ b\n", large), (2, None, large), (3, "u", large), (3, "u", large), (4, "u", None), (5, "u", None), (6, "u", "small"), (7, "u", "small"), (8, "u", "x" * 100_000), (None, "u", large)]
    packages, folder = Z.write_archives(pages(spark, rows))
    got = Z.read_archives(packages, folder, with_payload=True).collect()
    expected = []
    for i, _, html in rows:
        payload = (html or "").encode()
        again = html == large and i != 3
        expected.append((str(i), len(payload), sha1(payload).hexdigest(), "revisit" if again else "response", 3 if again else None))
    assert sorted(map(str, ((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got))) == sorted(map(str, expected))
    assert {r.page_id: bytes(r.payload).decode() for r in got if r.payload is not None} == {3: large, 4: "", 5: "", 6: "small", 7: "small", 8: "x" * 100_000}
    assert {r.url for r in got if r.page_id == 1} == {"http://a/%20b%0A"}
    assert Z.archived(pages(spark, [])).count() == 0


LABELS = "doc_id long, quality int, toxic int"


def test_hosts_paths_and_rules(spark):
    cases = {
        "http://WWW.Example.com/en/1?x": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "https://m.example.com/en/2#t": ("m.example.com", "/en/2", "example.com/en/", "block"),
        "https://example.com/de/": ("example.com", "/de/", "com/", "allow"),
        "http://a.net/es/9": ("a.net", "/es/9", "net/es/", "block"),
        "http://a.net/escape": ("a.net", "/escape", None, "allow"),
        "http://com": ("com", "", None, "allow"),
        "http://notcom/": ("notcom", "/", None, "allow"),
        "x://a.com?q=/en/": ("a.com", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "http:///p": ("", "/p", None, "allow"),
        None: ("", "", None, "allow"),
    }
    rows = [(k, u, "") for k, u in enumerate(cases)]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judged(pages(spark, rows), spark.createDataFrame([], LABELS)).collect()}
    assert [got[k] for k in range(len(rows))] == list(cases.values())


def template_of(paths):
    """Templates by the stated rule, level by level, in plain Python."""
    done = {p: "" for p in paths}
    parts = {p: [s for s in p.split("/") if s] for p in paths}
    for level in range(U.LEVELS):
        below, total = {}, {}
        for p in paths:
            if len(parts[p]) > level:
                key = (done[p], parts[p][level])
                below[key] = below.get(key, 0) + 1
                total[done[p]] = total.get(done[p], 0) + 1
        following = dict(done)
        for p in set(paths):
            if len(parts[p]) > level:
                n = below[done[p], parts[p][level]]
                literal = n >= U.MIN_COUNT and n >= U.MIN_SHARE * total[done[p]]
                following[p] = done[p] + "/" + (parts[p][level] if literal else "*")
        done = following
    return {p: t + ("/**" if len(parts[p]) > U.LEVELS else "/" if p.endswith("/") and parts[p] else "") for p, t in done.items()}


def test_templates_and_purity(spark):
    paths = [f"/news/{k}" for k in range(200)] + [f"/casino/win/{k}/" for k in range(100)] + [f"/shop/{k % 3}/item/{k}/x/y" for k in range(60)] + ["/about", "/"]
    rows = [(k, f"http://site.org{p}", "") for k, p in enumerate(paths)] + [(5000 + k, "http://other.org/casino/win/1/", "") for k in range(5)]
    labels = [(k, 0 if "casino" in p and k % 10 else 1, 0) for k, p in enumerate(paths) if k % 2] + [(1, 1, None), (99_999, 0, 1)]
    got = U.judged(pages(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    expected = template_of(paths)
    assert all(r.template == expected[r.path] for r in got if r.host == "site.org")
    verdicts = {(r.host, r.template): r.verdict for r in got}
    assert {t for (h, t), v in verdicts.items() if h == "site.org" and v == "block"} == {"/casino/win/*/"}
    assert all(v == "allow" for (h, _), v in verdicts.items() if h == "other.org")


def test_siblings_merge_unless_they_differ(spark):
    rows = [("h", "/a", 100, 5), ("h", "/b", 80, 6), ("h", "/c", 90, 80), ("h", "/d/e", 3, 1), ("g", "/a", 4, 4), ("h", "/n", 0, 0)]
    got = {(r.host, r.template): (r.labelled, r.bad) for r in U._branches(spark.createDataFrame(rows, "host string, template string, labelled long, bad long")).collect()}
    assert got == {("h", "/a"): (180, 11), ("h", "/b"): (180, 11), ("h", "/c"): (90, 80), ("h", "/d/e"): (3, 1), ("g", "/a"): (4, 4)}
    pooled = 11 / 180
    assert 6 / 80 - 5 / 100 < U.ALIKE_Z * sqrt(pooled * (1 - pooled) * (1 / 100 + 1 / 80))


def test_small_siblings_are_no_bridge_between_large_ones(spark):
    rows = [("h", "/articles", 1100, 0), ("h", "/news", 3, 0), ("h", "/faq", 3, 1), ("h", "/tags", 3, 2), ("h", "/blog", 3, 3), ("h", "/casino", 1000, 1000)]
    rows += [("h", f"/small{k}", 3, k % 4) for k in range(400)]
    got = {r.template: (r.labelled, r.bad) for r in U._branches(spark.createDataFrame(rows, "host string, template string, labelled long, bad long")).collect()}
    assert len(got) == len(rows)
    assert got["/casino"][1] / got["/casino"][0] > 0.75 and got["/articles"][1] / got["/articles"][0] < 0.25
    got = {r.template: (r.labelled, r.bad) for r in U._branches(spark.createDataFrame(rows[:6], "host string, template string, labelled long, bad long")).collect()}
    assert got["/casino"] == got["/blog"] == (1003, 1003) and got["/articles"] == (1103, 0) and got["/faq"] == got["/tags"] == (6, 3)


def test_sections_of_a_hot_host_and_deep_paths_stay_literal(spark):
    paths = [f"/s{k % 60}/{k}" for k in range(1200)] + [f"/a/b/c/d/{('good', 'casino')[k % 2]}/{k}" for k in range(60)]
    paths += [f"/deep{'/x' * 40}/{k}" for k in range(3)]
    rows = [(k, f"http://big.org{p}", "") for k, p in enumerate(paths)]
    labels = [(k, 0 if p.startswith("/s7/") or "casino" in p else 1, 0) for k, p in enumerate(paths) if k % 3]
    got = {r.path: (r.template, r.verdict) for r in U.judged(pages(spark, rows), spark.createDataFrame(labels, LABELS)).collect()}
    expected = template_of(paths)
    assert all(got[p][0] == expected[p] for p in paths)
    assert len(got) == len(paths) and got["/s7/7"] == ("/s7/*", "block") and got["/s8/8"] == ("/s8/*", "allow")
    assert got[paths[1201]] == ("/a/b/c/d/casino/*", "block") and got[paths[1200]] == ("/a/b/c/d/good/*", "allow")
    assert got[paths[-1]][0] == "/*" * 42


def test_empty_pages(spark):
    assert U.judged(pages(spark, []), spark.createDataFrame([], LABELS)).count() == 0
