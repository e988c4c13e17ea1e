"""Pages, archives, mixing, sharding, and the pipeline."""

import collections
import hashlib
import io
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lodestone.llm import exact_dedup, mixing, sharding, site_tree, warc
from lodestone.llm import queries as Q
from tests.compare import differences

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header>Site name</header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div><div class="ad">Buy</div>
<div id="main"><article><h1>Head &amp line</h1><p>One <b>bold<br>two</b>&nbsp; three &#233;<p>Next<div class="share">Share</div><form><input>Search</form></article></div>
<section class="comments"><p>Nice!</p></section><aside>Side</aside><footer>&copy; me</footer></body></html>"""


def test_main_text_of_a_page():
    assert site_tree.main_text(PAGE) == "Head & line One bold two three é Next"
    assert site_tree.main_text(None) == "" and site_tree.main_text("") == ""
    assert site_tree.main_text("plain &lt;text") == "plain <text"
    assert site_tree.main_text("<p>a<p>b</div></p><table><tr><td>c<td>d</table>") == "a b c d"
    assert site_tree.main_text("<article>x<!-- c --><script>y") == "x"
    assert site_tree.main_text("<div>" * 3000 + "deep") == "deep"


def test_style_tree_cuts_what_every_page_repeats(spark):
    pages = []
    for k in range(12):
        body = f"<div><p>Story {k} tells of {k * 7} things.</p><p>And ends {k}.</p></div>"
        pages.append((k, "http://a.org/x", f"<html><body><div class='top'><p>Welcome to our site</p></div>{body}<div class='bottom'><p>All rights kept</p></div></body></html>"))
    pages.append((50, "http://b.org/", "<body><div class='top'><p>Only here</p></div></body>"))
    pages += [(60, None, None), (61, "nonsense", ""), (None, "http://a.org/y", pages[3][2])]
    df = spark.createDataFrame([(*p, "t") for p in pages], "page_id long, url string, html string, text string")
    got = site_tree.extract(df).collect()
    assert len(got) == len(pages)
    by = {r.page_id: r for r in got}
    assert by[3].text == "Story 3 tells of 21 things. And ends 3." and by[3].n_chars == len(by[3].text)
    assert by[50].text == "Only here" and by[60].text == "" and by[61].n_chars == 0 and by[None].text == by[3].text
    low = {(r.host, r.whole) for r in site_tree.decisions(site_tree.style_tree(df)).collect()}
    assert low == {("a.org", False)}  # by entropy alone
    assert site_tree.extract(df.limit(0)).count() == 0
    # past the bound of what tasks hold whole, pages meet their nodes by host and salt
    for salts in (1, 5):
        assert sorted(map(str, site_tree.extract(df, broadcast_rows=0, salts=salts).collect())) == sorted(map(str, got))
    twice = site_tree.extract(df.union(df)).collect()
    assert sorted(map(str, twice)) == sorted(map(str, got + got))


def _unmarked(html):
    """A page without telling elements or names."""
    for tag in ("article", "nav", "footer"):
        html = html.replace(f"<{tag}>", "<div>").replace(f"</{tag}>", "</div>")
    return html.replace('class="ad"', 'class="b"')


def test_the_tree_alone_finds_the_articles(spark):
    """Without any mark, menus, adverts and footers that differ from page to page go by the tree."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").collect()
    df = spark.createDataFrame([(r.page_id, r.url, _unmarked(r.html)) for r in pages], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in site_tree.extract(df).collect()}
    assert [r.page_id for r in pages if got[r.page_id] != _article(r.html)] == []
    assert not any(site_tree.main_text(_unmarked(r.html)) == got[r.page_id] for r in pages)


def test_small_hosts_borrow_from_sites_of_the_same_make(spark):
    """Hosts of one to three pages, and none else: marks are gone, layouts of other hosts tell."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    by = collections.defaultdict(list)
    for r in pages:
        by[site_tree.host_of(r.url)].append(r)
    small = [r for rs in by.values() if len({r.html for r in rs}) < site_tree.PAGES for r in rs]
    assert len(small) > 50
    for some in (pages, small):
        df = spark.createDataFrame([(r.page_id, r.url, _unmarked(r.html)) for r in some], "page_id long, url string, html string")
        got = {r.page_id: r.text for r in site_tree.extract(df).collect()}
        assert [r.page_id for r in some if got[r.page_id] != _article(r.html)] == []


def test_copies_on_many_hosts_are_no_boilerplate(spark):
    story = "<body><div><div><p>One long story that many hosts print word by word and at length</p></div><div><p>Host {0}</p></div></div></body>"
    df = spark.createDataFrame([(k, f"http://h{k}.org/", story.format(k)) for k in range(9)], "page_id long, url string, html string")
    assert all(r.text.startswith("One long story") for r in site_tree.extract(df).collect())


def test_the_tree_judges_doubtful_names(spark):
    page = "<body><div class='has-sidebar'><p>Long story {0} told in very many words {0} that go on and on</p></div><div class='post-related'><p>See {0}</p></div></body>"
    df = spark.createDataFrame([(k, "http://a.org", page.format(k)) for k in range(8)], "page_id long, url string, html string")
    assert {r.text for r in site_tree.extract(df).collect()} == {f"Long story {k} told in very many words {k} that go on and on" for k in range(8)}
    few = site_tree.extract(df.limit(2)).collect()  # too few pages to tell
    assert all(r.text.endswith(f"See {r.page_id}") for r in few)


@pytest.mark.parametrize("html", ["<div>" * 50_000 + "x", "<b>" * 50_000 + "<div>" * 50_000 + "x", "<ul><li>" + "<b>" * 50_000 + "<li></li>" * 20_000 + "x", "<div>" + "<b>" * 50_000 + "x" + "</b>" * 50_000 + "</i>" * 50_000, "<table><td>" * 20_000 + "x"])
def test_deep_pages_cost_their_length(html):
    import time

    began = time.process_time()
    assert site_tree.main_text(html) == "x" and len(site_tree.observe(html)) <= 50_000
    assert time.process_time() - began < 20


def test_copies_of_a_page_are_no_evidence(spark):
    body = "<html><body><div><p>{}</p></div></body></html>"
    article = "<body><article><p>Text {}</p>{}</article></body>"
    listed = article.format("with a list", "<ul><li>One</li></ul>")
    pages = [("http://copied.org/", body.format("Story"))] * 6 + [("http://mixed.org/", body.format("Copied"))] * 90
    pages += [("http://mixed.org/", body.format(f"Distinct {k}")) for k in range(10)]
    pages += [("http://lists.org/", listed)] * 5 + [("http://lists.org/", article.format(k, "")) for k in range(5)]
    got = site_tree.extract(spark.createDataFrame([(k, *p) for k, p in enumerate(pages)], "page_id long, url string, html string")).collect()
    text = {r.page_id: r.text for r in got}
    assert {text[k] for k in range(6)} == {"Story"} and {text[k] for k in range(6, 96)} == {"Copied"}
    assert [text[96 + k] for k in range(10)] == [f"Distinct {k}" for k in range(10)]
    assert {text[k] for k in range(106, 111)} == {"Text with a list One"}
    # where the cuts leave nothing the page stays whole
    body = site_tree.parse("<body><p>All</p></body>").children[0]
    assert site_tree.main_text("<body><p>All</p></body>", {body.id}) == site_tree.main_text("<body><p>All</p></body>", set(), {body.id, body.children[0].id}) == "All"


@pytest.mark.parametrize("attribute", ["class='layout has-sidebar'", "id='page' class='no-sidebar'", "class='with-menu'", "class='post-related'", "id='skip-target'"])
def test_a_word_in_a_name_is_no_noise(attribute):
    assert site_tree.main_text(f"<body><div {attribute}><p>Kept</p></div></body>") == "Kept"
    assert site_tree.main_text(f"<body><div {attribute}><main>Kept</main></div></body>") == "Kept"


def test_what_holds_the_main_text_is_no_noise():
    assert site_tree.main_text("<body><div class='sidebar'><main>Kept</main></div><div class='cookie-notice'>No</div></body>") == "Kept"
    assert site_tree.main_text("<form><div role='menu'><article>Kept</article></div></form>") == "Kept"
    assert site_tree.main_text("<p>Kept</p><div class='cookie-notice ad-300'>No</div><div class='comments'><article class='comment'>No</article></div>") == "Kept"


def _article(page):
    import html
    import re

    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    return " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", inner))).split())


def test_site_query_against_the_template(spark, sf_dir):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in Q.op2_site_style_tree(spark, sf_dir).collect():
        assert r.text == _article(pages[r.page_id])


def test_salvage():
    one, two, three = (warc.record(f"urn:page:{k}", "http://x", b"p" * 50 * k) for k in (1, 2, 3))
    pack = lambda raw: zlib.compressobj(6, zlib.DEFLATED, 31)

    def member(raw):
        z = pack(raw)
        return z.compress(raw) + z.flush()

    class File(io.BytesIO):
        def read_at(self, n, at):
            return self.getbuffer()[at : at + n].tobytes()

    def run(raw):
        return [(k, a, b, x if k == "gap" else x["warc-record-id"]) for k, a, b, x, _ in warc.records_of(File(raw), len(raw))]

    m1, m2, m3 = member(one), member(two), member(three)
    whole = m1 + m2 + m3
    assert [r[3] for r in run(whole)] == ["<urn:page:1>", "<urn:page:2>", "<urn:page:3>"]
    hurt = bytearray(whole)
    hurt[len(m1) + len(m2) // 2] ^= 0xFF
    got = run(bytes(hurt))
    assert [(r[0], r[1], r[2]) for r in got] == [("record", 0, len(m1)), ("gap", len(m1), len(m1) + len(m2)), ("record", len(m1) + len(m2), len(whole))]
    assert [r[0] for r in run(b"junk" + m1 + b"\x1f\x8b\x08 more junk" + two + m3[:-9])] == ["gap", "record", "gap", "record", "gap"]
    plain = one + two.replace(b"Content-Length: ", b"Content-Length: 9", 1) + three
    assert [r[0] for r in run(plain)] == ["record", "gap", "record"]
    swapped = one.replace(b"pppp\r\n", b"qqqq\r\n")
    assert [r[0] for r in run(swapped + two)] == ["gap", "record"]
    assert run(b"") == [] and [r[0] for r in run(b"nothing here")] == ["gap"]
    # a member of many records: each is read, damage inside costs only the record it hits
    many = member(one + two + three)
    assert [(r[0], r[3]) for r in run(many + m1)] == [("record", f"<urn:page:{k}>") for k in (1, 2, 3, 1)]
    inner = run(member(one + two.replace(b"pppp", b"qqqq", 1) + three))
    assert [r[0] for r in inner] == ["record", "gap", "record"] and "inflated bytes" in inner[1][3]

    noise = [warc.record(f"urn:page:{k}", None, random.Random(k).randbytes(200_000)) for k in range(4)]
    packed = bytearray(member(b"".join(noise)))
    packed[len(packed) * 5 // 8] ^= 0xFF
    cut_off = run(bytes(packed[: len(packed) * 7 // 8]) + m1)
    assert [r[3] for r in cut_off if r[0] == "record"][:2] == ["<urn:page:0>", "<urn:page:1>"] and cut_off[-1][3] == "<urn:page:1>"
    assert "gap" in [r[0] for r in cut_off] and len(cut_off) <= 5
    # without a digest of its own a record needs the member's checksum
    bare = b"WARC/1.0\r\nContent-Length: 400\r\n\r\n" + b"a" * 400 + b"\r\n\r\n"
    wrong = bytearray(member(bare))
    wrong[-6] ^= 1
    assert [k for k, *_ in warc.records_of(File(bytes(wrong)), len(wrong))] == ["gap"]
    assert [k for k, *_ in warc.records_of(File(member(bare)), len(member(bare)))] == ["record"]


class _File(io.BytesIO):
    def read_at(self, n, at):
        return self.getbuffer()[at : at + n].tobytes()


def _member(raw, level=6):
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def _salvaged(raw, records):
    """Which of ``records`` come out, by their blocks, and the gaps, in order."""
    known = {r.partition(b"\r\n\r\n")[2][:-4]: k for k, r in enumerate(records)}
    rows = list(warc.records_of(_File(raw), len(raw)))
    spans = [(a, b) for k, a, b, _, _ in rows if k == "gap"]
    assert all(a < b for a, b in spans) and all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
    return [known[block] for k, _, _, _, block in rows if k == "record"], spans


@pytest.mark.parametrize("level", [0, 6])
def test_a_wrong_trailer_costs_no_record(level):
    own = [warc.record(f"urn:page:{k}", None, bytes([96 + k]) * 300) for k in range(3)]
    first = _member(own[0] + own[1], level)
    for at in range(1, 9):
        hurt = bytearray(first + _member(own[2]))
        hurt[len(first) - at] ^= 0x41
        assert _salvaged(bytes(hurt), own) == ([0, 1, 2], [(len(first) - 8, len(first))])
    assert _salvaged(bytes(hurt[: len(first)]), own) == ([0, 1], [(len(first) - 8, len(first))])
    assert _salvaged(first[:-3] + _member(own[2]), own) == ([0, 1, 2], [(len(first) - 8, len(first) - 3)])


def test_members_that_inflate_a_thousandfold():
    own = [warc.record(f"urn:page:{k}", None, bytes([96 + k]) * 9_000_000) for k in range(3)]
    for raw in (b"".join(map(_member, own)), _member(b"".join(own)), _member(own[0]) + own[1] + _member(own[2])):
        assert _salvaged(raw, own) == ([0, 1, 2], [])


def test_what_was_inflated_before_a_fault_stays():
    """A fault in the first 64 KB of input loses no record before it, and the gap begins behind the last one."""
    records = [warc.record(f"urn:page:{k}", None, random.Random(k).randbytes(900)) for k in range(20)]
    whole = bytearray(_member(b"".join(records)))
    whole[len(whole) * 3 // 4] ^= 0xFF
    records.append(warc.record("urn:page:99", None, b"after"))
    whole += _member(records[-1])
    found, spans = _salvaged(bytes(whole), records)
    assert found[:14] == list(range(14)) and found[-1] == 20 and len(found) == len(set(found))
    assert sum(b - a for a, b in spans) < len(whole) // 3


@pytest.mark.parametrize("level", [0, 1, 9])
@pytest.mark.parametrize("change", [0x01, 0xFF])
def test_damage_at_every_place(level, change):
    """One wrong byte costs no record but the one that holds it, and none comes twice.

    Members of one record, of three, and a plain record: of a compressed member of many,
    the records from the wrong byte on may go, those before it stay.
    """
    record = [warc.record(f"urn:page:{k}", "http://x/é", random.Random(k).randbytes(60) + b"text " * 12) for k in range(6)]
    parts = [(_member(record[0], level), [0]), (_member(b"".join(record[1:4]), level), [1, 2, 3]), (record[4], [4]), (_member(record[5], level), [5])]
    raw = b"".join(p for p, _ in parts)
    assert _salvaged(raw, record) == (list(range(6)), [])
    start = 0
    for part, ids in parts:
        for at in range(start, start + len(part)):
            hurt = bytearray(raw)
            hurt[at] ^= change
            found, _ = _salvaged(bytes(hurt), record)
            assert len(found) == len(set(found)), at
            lost = set(range(6)) - set(found)
            if level == 0 or len(ids) == 1:
                assert len(lost) <= 1 and lost <= set(ids), (at, lost)
            else:
                assert lost <= set(ids), (at, lost)
                z = zlib.decompressobj(31)
                try:
                    out = z.decompress(raw[start:at])
                except zlib.error:
                    out = b""
                sound, told = [], 0
                for k in ids:
                    told += len(record[k])
                    if told <= len(out):
                        sound.append(k)
                assert not lost & set(sound), (at, lost, sound)
        start += len(part)


@pytest.mark.parametrize("level", [0, 6])
def test_an_archive_cut_at_every_place(level):
    record = [warc.record(f"urn:page:{k}", None, random.Random(k).randbytes(80)) for k in range(4)]
    parts = [(_member(record[0], level), [0]), (record[1], [1]), (_member(record[2] + record[3], level), [2, 3])]
    raw = b"".join(p for p, _ in parts)
    for at in range(len(raw)):
        found, spans = _salvaged(raw[:at], record)
        ends = [sum(len(p) for p, _ in parts[: k + 1]) for k in range(3)]
        whole = [i for (_, ids), end in zip(parts, ends) if end <= at for i in ids]
        assert found[: len(whole)] == whole and len(found) == len(set(found))
        # what is cut off is a gap to the end, unless every byte of the record is there
        assert not spans or spans[-1][1] == at


def _warc_brute(pages):
    last = {}
    for i, h in pages:
        b = (h or "").encode()
        if len(b) >= 1000 and i is not None:
            last[b] = max(last.get(b, i), i)
    out = []
    for i, h in pages:
        b = (h or "").encode()
        again = i is not None and len(b) >= 1000 and last[b] != i
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", last[b] if again else None))
    return sorted(out, key=str)


def test_warc_round_trip(spark):
    pages = [(1, "x" * 1000), (2, "x" * 1000), (3, "x" * 999), (4, "x" * 999), (5, None), (6, ""), (7, "é" * 500), (9, "é" * 500), (None, "y" * 2000), (10, "\r\n\r\nWARC/1.0\r\n" * 90), (2, "x" * 1000), (12, "z" * 3_000_000)]
    df = spark.createDataFrame([(i, "http://h/\r\nX: y" if i == 1 else None, h, "k") for i, h in pages], "page_id long, url string, html string, digest string")
    got = warc.round_trip(df)
    assert sorted((tuple(r) for r in got.collect()), key=str) == _warc_brute(pages)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_small_pages_and_long_urls(spark):
    """Small pages share no key, and a url of any length is read back."""
    rows = [(k, "http://h/" + "u" * (9_000_000 if k == 7 else 3), "tiny" if k % 2 else None) for k in range(4000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        folder = f"{warc.shared_dir(spark)}/small"
        files = warc.archive_pages(df, folder).collect()
        assert len(files) == 4 and max(f.records for f in files) < 2000
        assert warc.round_trip(df).count() == len(rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_warc_gaps_are_logged(spark, tmp_path):
    df = spark.createDataFrame([(k, None, f"page {k} " * 200) for k in range(20)], "page_id long, url string, html string").coalesce(1)
    folder = f"file://{tmp_path}/w"
    path = warc.archive_pages(df, folder).first().path.removeprefix("file://")
    raw = bytearray(open(path, "rb").read())
    hit = warc.read(warc.list_files(spark, folder)).orderBy("start").collect()[10]
    at = hit.stop - 24  # in its text: damage to a header's wording or a trailer costs no record
    raw[at] ^= 0x55
    open(path, "wb").write(raw)
    rows = warc.read(warc.list_files(spark, folder))
    assert rows.filter("kind = 'record'").count() == 19
    gap = warc.gaps(rows).collect()
    assert len(gap) == 1 and gap[0].start <= at < gap[0].stop and gap[0].reason


def _targets_brute(sizes, most=3):
    weights = {s: k % 3 + 1 for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    left, open_, target = float(sum(sizes.values())), set(sizes), {}
    while open_:
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if level * weights[s] > most * sizes[s]}
        if not full:
            return target | {s: level * weights[s] for s in open_}
        for s in full:
            target[s] = float(most * sizes[s])
            left -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1, "c": 1, None: 40}, {"a": 5}, {"a": 0, "b": 0}, {"a": 100, "b": 1, "c": 2, "d": 3, "e": 50, "f": 1}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(_targets_brute(sizes))


def _draw(*parts):
    return int(hashlib.md5("|".join("~" if p is None else str(p) for p in parts).encode()).hexdigest()[:15], 16)


def _mix_brute(rows):
    """Every taking's position, one document after the other."""
    size = [len((t or "").split()) for _, t, _ in rows]
    total = collections.Counter()
    for n, (_, _, s) in zip(size, rows):
        total[s] += n
    target = _targets_brute(dict(total))
    out = []
    for source in total:
        tilt = (_draw(7, source) % 2001 - 1000) / 1000 * 0.5
        line = [(_draw(i, s, n), i is None, i or 0, n, i) for n, (i, _, s) in zip(size, rows) if s == source]
        before = 0
        for *_, n, i in sorted((h >> 20 & 1023, h, *rest) for h, *rest in line):
            whole = int(target[source] // total[source]) if total[source] else 0
            takes = whole + (n > 0 and before + n / 2 <= target[source] - whole * total[source])
            places = []
            for k in range(takes):
                share = (before + k * total[source]) / target[source]
                lo, hi = 0.0, 1.0
                for _ in range(60):  # the demand is inverted by halving
                    t = (lo + hi) / 2
                    lo, hi = (t, hi) if (1 + tilt) * t - tilt * t * t < share else (lo, t)
                places.append(lo)
            out.append((i, n, total[source], target[source], n * takes, places))
            before += n
    return out


def test_positions_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(k, "w " * rng.randrange(30), rng.choice(["b", "a", None, "c", "c", "c"])) for k in range(400)] + [(900, None, "a"), (901, "", "z"), (None, "q q", "a"), (902, "long " * 60_000, "b")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, position int, __size int")
    got = sorted(((r.doc_id, r.size, r.source_size, r.target, r.taken, r.positions, r.position) for r in mixing.mix(df).collect()), key=lambda r: str(r[0]))
    want = sorted(_mix_brute(rows), key=lambda r: str(r[0]))
    assert [g[:3] + g[4:5] for g in got] == [w[:3] + w[4:5] for w in want]
    for g, w in zip(got, want):
        assert g[3] == pytest.approx(w[3]) and g[5] == pytest.approx(w[5], abs=1e-7) and g[6] == (g[5][0] if g[5] else None)


def test_mix(spark):
    rows = [(k, " ".join(["w"] * (k % 17)), ["b", "a", None, "c"][min(3, k % 7)]) for k in range(300)] + [(900, None, "a"), (901, "", "z"), (None, "q q", "a"), (5, "w " * 5, "c")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    size = collections.Counter()
    for _, t, s in rows:
        size[s] += len((t or "").split())
    want = _targets_brute({s: size[s] for s in {r[2] for r in rows}})
    assert sum(r.target * r.size / r.source_size for r in got if r.source_size) == pytest.approx(sum(size.values()))
    by = collections.Counter()
    for r in got:
        assert r.taken <= 3 * r.size
        by[r.source_size, round(r.target, 6)] += r.taken
    for s, t in want.items():
        if size[s]:
            assert abs(by[size[s], round(t, 6)] - t) <= 17
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mix(df.limit(0)).count() == 0


def test_curriculum_orders_and_repeats(spark):
    rows = [(k, " ".join(["w"] * (1 + k % 5)), "abc"[k % 3]) for k in range(200)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, at int")
    mixed = mixing.curriculum(df, partitions=3)
    assert mixed.columns == df.columns
    takes = {r.doc_id: r.taken // r.size for r in mixing.mix(df).collect()}
    assert collections.Counter(r.doc_id for r in mixed.collect()) == collections.Counter({k: v for k, v in takes.items() if v})
    # positions invert the demand: D(t) = target ((1 + tilt) t - tilt t^2)
    row = spark.range(1).select(*[mixing.position(F.lit(x * 10.0), F.lit(10.0), F.lit(b)).alias(f"p{i}") for i, (x, b) in enumerate([(0.3, 0.5), (0.3, -0.5), (0.0, 0.5), (1.0, -0.5), (0.4, 0.0)])]).first()
    for t, (x, b) in zip(row, [(0.3, 0.5), (0.3, -0.5), (0.0, 0.5), (1.0, -0.5), (0.4, 0.0)]):
        assert (1 + b) * t - b * t * t == pytest.approx(x)


def test_mix_query_deals_positions_in_training_order(spark, tmp_path):
    rows = [(k, " ".join(["w"] * (k % 6)), "abc"[k % 3]) for k in range(200)] + [(5, "x y", "b"), (None, "z", None), (201, None, "a")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = Q.op9_curriculum_mix(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    assert all(r.taken == r.size * len(r.positions) and list(r.positions) == sorted(r.positions) for r in got)
    firsts = [r.positions[0] for r in got if r.positions]
    assert firsts == sorted(firsts) and not any(r.positions for r in got[len(firsts) :]) and len(set(firsts)) > 50
    # the training order that the positions tell is that of the mix itself
    dealt = [r.doc_id for r in mixing.curriculum(spark.read.parquet(f"{tmp_path}/documents.parquet")).collect()]
    told = [i for *_, i in sorted((p, r.doc_id is not None, r.doc_id or 0, r.doc_id) for r in got for p in r.positions)]
    assert told == dealt


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_permutation_is_one(spark, n):
    got = spark.range(n).select(sharding.permute(F.col("id"), F.lit(n).cast("long"), 9).alias("y")).collect()
    assert sorted(r.y for r in got) == list(range(n))


def _permuted(x, n, key):
    import math

    a = math.ceil(math.sqrt(n))
    b = math.ceil(n / a) + 1
    while True:
        left, right = divmod(x, b)
        for k in range(sharding.ROUNDS):
            if k % 2:
                right = (right + _draw(left, key, k)) % b
            else:
                left = (left + _draw(right, key, k)) % a
        x = left * b + right
        if x < n:
            return x


def test_shards_against_brute_force(spark):
    rows = [(k, "é" * (k % 7)) for k in range(250)] + [(None, None), (3, "again"), (3, "again")]
    keyed = [(i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t in rows]
    order = sorted(keyed, key=lambda r: (_draw(*r) >> 20 & 4095, _draw(*r), r[0] is None, r[0] or 0, r[1:]))
    want = collections.Counter()
    for number, (i, crc, size) in enumerate(order):
        at = _permuted(number, len(rows), sharding.KEY)
        want[i, size, crc, at % 16, at // 16] += 1
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert collections.Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in got) == want


def test_shards(spark):
    rows = [(k, "x" * (k % 9)) for k in range(333)] + [(None, None), (None, None), (5, "dup"), (5, "dup"), (7, "é" * 100_000)]
    df = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, shard int")
    got = sharding.shard(df).collect()
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1 and set(by) == set(range(16))
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert sorted((r.size, r.text_crc32) for r in got) == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in rows)
    assert sorted(map(str, sharding.shard(df.repartition(9)).collect())) == sorted(map(str, got))
    assert sharding.shard(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_queries_with_sql(spark, sf_dir, name):
    assert differences(spark, Q.QUERIES[name], Q.ORACLES[name], sf_dir) == ""


def test_pipeline_stage_by_stage(spark, sf_dir):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "near dedup", "source mix", "byte BPE"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, rows = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir).cache()
        assert out.columns == columns, name
        if name == "language ID":
            assert out.count() >= 0.97 * rows
        if name == "exact dedup":
            assert exact_dedup.mark(out).filter("NOT kept").count() == 0 and out.count() < docs.count()
        if name == "near dedup":
            from lodestone.llm import superminhash

            assert superminhash.components(docs).filter("kept").count() == out.count()
        docs = out
    final = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    texts = collections.Counter((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in docs.collect())
    assert collections.Counter((r.doc_id, r.decoded_sha256) for r in final.collect()) == texts
    ran = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(str, ran.collect())) == sorted(map(str, final.collect()))


EDGES = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n ", None, None), (4, "the cat and the dog sat on the mat " * 8, "en", "a"), (4, "the cat and the dog sat on the mat " * 8, "en", "a"),
    (5, "the cat and the dog sat on the mat " * 8 + "too", "en", "b"), (6, "der hund und die katze sind im haus " * 8, "de", "b"), (None, "der hund und die katze gehen nach haus " * 8, "de", None),
    (7, "123 456", "de", "b"), (8, "the dog and the house " * 40_000, "en", "b"), (9, "der hund " * 30, None, "z"), (9, "the dog " * 30, "en", "z"),
]


def test_pipeline_stages_on_every_kind_of_row(spark):
    import corpus_pipeline

    rows = [(*r, len(r[1] or ""), "x", 1, 2.0) for r in EDGES]
    # names the operators use themselves
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, size int, score double")
    stages = dict(corpus_pipeline.STAGES)
    out = {}
    for name, stage in list(stages.items())[:-1]:
        got = stage(spark, docs, "/nowhere")
        assert got.columns == docs.columns, name
        out[name] = sorted((str(r.doc_id), (r.text or "")[:30], r.kept, r.size, r.score) for r in got.collect())
        assert set(out[name]) <= {(str(i), (t or "")[:30], "x", 1, 2.0) for i, t, *_ in rows}, name
        assert stage(spark, docs.limit(0), "/nowhere").count() == 0, name
    assert not {i for i, *_ in out["language ID"]} & {"1", "2", "3", "7"} and {i for i, *_ in out["language ID"]} >= {"4", "6", "8"}
    assert [i for i, *_ in out["exact dedup"]] == sorted(["1", "3", "4", "5", "6", "None", "7", "8", "9", "9"])
    assert [i for i, *_ in out["near dedup"]] == sorted(["1", "2", "3", "4", "4", "6", "None", "7", "8", "9", "9"])
    final = stages["byte BPE"](spark, docs, "/nowhere").collect()
    assert sorted((str(r.doc_id), r.decoded_sha256) for r in final) == sorted((str(i), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in rows)
    assert stages["byte BPE"](spark, docs.limit(0), "/nowhere").count() == 0


def test_pipeline_decisions_by_brute_force(spark):
    """Each stage's rows from plain Python over the rows its predecessor kept."""
    import corpus_pipeline

    from tests.llm.test_text_ops import _dedup_brute, _expected, _near_brute

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language ID"](spark, docs, "").cache()
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    want = sorted(i for i, _, _, k, _ in _dedup_brute(rows) if k)
    kept = stages["exact dedup"](spark, kept, "").cache()
    assert sorted(r.doc_id for r in kept.collect()) == want
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    want = sorted(i for i, (_, c) in _near_brute(rows).items() if i == c)
    kept = stages["near dedup"](spark, kept, "").cache()
    assert sorted(r.doc_id for r in kept.collect()) == want
    rows = [(r.doc_id, r.text, r.source) for r in kept.collect()]
    takes = sorted((p, i) for i, *_, places in _mix_brute(rows) for p in places)
    mixed = stages["source mix"](spark, kept, "").collect()
    assert collections.Counter(r.doc_id for r in mixed) == collections.Counter(i for _, i in takes)
    places = {}
    for p, i in takes:
        places.setdefault(i, []).append(p)
    dealt = [places[r.doc_id].pop(0) for r in mixed]
    assert all(a <= b + 1e-9 for a, b in zip(dealt, dealt[1:]))
    final = stages["byte BPE"](spark, spark.createDataFrame(mixed, docs.schema), "").collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in final) == sorted((r.doc_id, *_expected(r.text)) for r in mixed)
