"""Archives, page text and pieces: round trips, the library's own results, and broken input."""
from __future__ import annotations

import base64
import hashlib
import html
import io
import random
import re
import struct

import pytest
import sentencepiece
import zstandard
from pyspark.sql import functions as F

from dayloom.llm import extract, pieces, warc
from dayloom.session import scratch_path
from tests.llm.helpers import PAGES, documents, with_clashes

FOLDER = "/root/testdata/sf0.001"


# ---- archives


def page_rows(spark):
    rows = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()]
    rows += [(10**9 + i, u, h) for i, (u, h) in enumerate(zip(
        [None, "", " a\r\nWARC-Type: x", "b64:z", "http://é.x/", "u", "u", None],
        [None, "", "", "é𝄞\r\n\r\n" * 5, rows[0][2], rows[0][2], "x" * 3_000_000, "\r\n\r\nWARC/1.1\r\n"], strict=True,
    ))]
    return rows + [(None, "n", rows[1][2]), (None, "n", "only here"), (None, "n", "only here"), rows[3]]


def test_pages_come_back_from_archives(spark):
    rows = page_rows(spark)
    pages = with_clashes(spark.createDataFrame(rows, PAGES)).repartition(3)
    folder = scratch_path(spark, "warc-test")
    got = warc.read_warc(spark, warc.write_warc(pages, folder), folder).collect()
    assert len(got) == len(rows)
    by_digest: dict = {}
    for i, _, h in rows:
        by_digest.setdefault(base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(), []).append((i is None, i))
    want, urls = [], {}
    for i, u, h in rows:
        data = (h or "").encode()
        d = base64.b32encode(hashlib.sha1(data).digest()).decode()
        first = min(by_digest[d])[1]
        want.append((str(i), len(data), d, str(first)))
        urls.setdefault(str(i), set()).add(u)
    assert sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"]) for r in got) == sorted(w[:3] for w in want)
    assert all(r["url"] in urls[str(r["page_id"])] for r in got)
    firsts = {d: f for _, _, d, f in want}
    responses = [r for r in got if r["record_type"] == "response"]
    assert sorted(r["payload_digest"] for r in responses) == sorted(by_digest)
    for r in got:
        if r["record_type"] == "response":
            assert r["refers_to"] is None and str(r["page_id"]) == firsts[r["payload_digest"]]
            assert warc.digest_of(bytes(r["payload"])) == r["payload_digest"]
        else:
            assert str(r["refers_to"]) == firsts[r["payload_digest"]]
    assert warc.round_trip(pages.limit(0)).count() == 0


def archive(records: list[bytes]) -> bytes:
    out = io.BytesIO()
    assert warc.write_archive(out, iter(records)) == len(records)
    return out.getvalue()


def test_an_archive_leads_with_its_dictionary_and_has_a_frame_a_record():
    random.seed(1)
    bodies = [("<p>menu home about " + " ".join(random.choices(["alpha", "beta", "gamma", "delta"], k=90))).encode() for _ in range(300)]
    records = [warc.record_bytes(i, f"http://x/{i}", b, None, warc.digest_of(b), len(b)) for i, b in enumerate(bodies)]
    data = archive(records)
    magic, size = struct.unpack("<II", data[:8])
    assert magic == warc.DICTIONARY_MAGIC and size > 0
    assert data[8 + size :].count(struct.pack("<I", warc.FRAME_MAGIC)) >= 300
    assert [r["payload"] for r in warc.read_archive(io.BytesIO(data))] == bodies
    packed = zstandard.ZstdCompressor().compress(data[8 : 8 + size])  # the dictionary may be a frame itself
    assert len(list(warc.read_archive(io.BytesIO(struct.pack("<II", magic, len(packed)) + packed + data[8 + size :])))) == 300
    for broken in (data[:-3], data[:6], data[8 + size :], data[: 8 + size] + b"junk", data[:5] + b"\xff" + data[6:]):
        with pytest.raises(warc.BadArchive):
            list(warc.read_archive(io.BytesIO(broken)))


@pytest.mark.parametrize("old,new", [
    (b"WARC/1.1", b"WARC/9"), (b"WARC-Type: response\r\n", b""), (b"WARC-Type: response", b"WARC Type: response"), (b"abc", b"abcd"), (b"abc", b"abd"),
    (b"Content-Length: ", b"Content-Length: 1"), (b"WARC-Date", b"WARC-Type"), (b"\r\n\r\n", b"\n\n"),
])
def test_broken_records_are_refused(old, new):
    record = warc.record_bytes(1, "http://x", b"abc", None, warc.digest_of(b"abc"), 3)
    assert warc.parse_record(record)["payload"] == b"abc"
    with pytest.raises(warc.BadArchive):
        warc.parse_record(record.replace(old, new))


# ---- page text


def article(page: str) -> str:
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = [re.sub("<[^>]*>", "", x) for x in re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))]
    return "\n".join(t for x in parts if (t := re.sub(r"\s+", " ", html.unescape(x)).strip()))


def test_articles_are_extracted_whole(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    odd = spark.createDataFrame([(-1, None, None), (-2, "u", ""), (-3, "u", "<nav>x</nav>")], PAGES)
    got = {r["page_id"]: r for r in extract.extract_pages(with_clashes(pages.unionAll(odd).unionAll(odd))).collect()}
    for r in pages.collect():
        text = got[r["page_id"]]["text"]
        assert text == article(r["html"]) and got[r["page_id"]]["n_chars"] == len(text) and got[r["page_id"]]["url"] == r["url"]
    assert [got[i]["text"] for i in (-1, -2, -3)] == ["", "", ""]
    assert extract.extract_pages(pages.limit(0)).count() == 0


LONG = "A sentence that is long enough to be a paragraph of its own in this text. " * 3


@pytest.mark.parametrize("page,text", [
    (f"<div class='post'><h1>T</h1><p>{LONG}<p>short</div><div id=comments><p>{LONG}</div><div class='cookie-notice'>{LONG}</div>", f"T\n{LONG.strip()}\nshort"),
    (f"<header>{LONG}</header><main><p>a &amp;amp; b&nbsp;&eacute;&#x41;<br>c</p></main><footer>{LONG}</footer>", "a &amp; b éA c"),
    ("<article>x<header><h1>H</h1></header><script>var a='</article>'</script>y<aside>no</aside><!-- <p> -->z<form>f</form></article>tail", "x\nH\ny\nz"),
    (f"<ul><li><a href=1>Home page</a><li><a href=2>About us</a></ul><p>{LONG}</p><ul class=menu><li>q</ul>", LONG.strip()),
    ("a < b", ""), ("<p" * 50, ""), ("<!-- never closed " + LONG, ""), (f"<style>{LONG}", ""), (f"<article><p title='>'>{LONG} <b>bold", LONG + "bold"),
])
def test_other_page_shapes(page, text):
    assert extract.main_text(page) == text


@pytest.mark.parametrize("page,text", [
    (f"<nav><ul>{'<li>x' * 70}</ul></nav><article><p>Body</article>", "Body"),
    (f"<footer><table>{'<tr><td>x<td>y' * 70}</table></footer><main>Body</main>", "Body"),
    (f"<form><dl>{'<dt>x<dd>y' * 70}</form><p>{LONG}", LONG.strip()),
    (f"<nav>{'<i>x' * 200}</nav><article>Body</article>", "Body"),
    (f"<p class=advert>Ad<p>{LONG}", LONG.strip()), (f"<p class=advert><b>Ad<div>{LONG}</div>", LONG.strip()),
    (f"<ul><li class=promo>Ad<li>{LONG}</ul>", LONG.strip()), (f"<ul><li class=promo>Ad<ul><li>no</ul>no<li>{LONG}</ul>", LONG.strip()),
    (f"<table><tr><td class=advert>Ad<td>{LONG}<tr class=promo><td>no<tr><td>end</table>", LONG.strip() + "\nend"),
    (f"<p><a href=1><div>{LONG}</div></a><p>{LONG[:90]}", LONG[:90].strip()),
])
def test_ends_that_are_left_out(page, text):
    assert extract.main_text(page) == text


@pytest.mark.parametrize("page,text", [
    (f"<div class='content has-sidebar'><p>{LONG}</div><div class=sidebar><p>no</div>", LONG.strip()),
    (f"<div id=page class='right-sidebar'><article>Body</article><div class=sidebar>{LONG}</div></div>", "Body"),
    (f"<div class='post comments-open'><p>{LONG}</div><div id=comments>{LONG}{LONG}</div>", LONG.strip()),
    (f"<section class='ad-free'><p>{LONG}</section><div class='cookie-notice'>{LONG}{LONG}</div>", LONG.strip()),
    (f"<div class=sidebar-left><div class=social><main>Body</main>{LONG}</div></div><p>{LONG}{LONG}", "Body"),
    (f"<div class='layout sidebar'><div class=share><a href=1>{LONG}</a>no</div><p>{LONG}<p>end</div><p>tail", f"{LONG.strip()}\nend\ntail"),
    (f"<article>Body</article><div id=comments><article>{LONG}</article></div>", "Body"),
    (f"<article>Body</article><div class=comments-list>{LONG}</div>", "Body"),
])
def test_hints_spare_what_holds_the_text(page, text):
    assert extract.main_text(page) == text


COMMENTS = "".join(f"<li><article class=comment-body><div>{LONG}</div></article></li>" for _ in range(2))


@pytest.mark.parametrize("page,text", [
    (f"<div class=entry-content><p>{LONG}<p>{LONG}</div><ol class=comment-list>{COMMENTS}</ol>", f"{LONG.strip()}\n{LONG.strip()}"),
    (f"<div class=post><p>{LONG}</div><div id=comments><article>no</article></div>", LONG.strip()),
    (f"<div class=body><p>{LONG}<p>{LONG}</div><section><article><h3>Teaser</h3></article></section>", f"{LONG.strip()}\n{LONG.strip()}\nTeaser"),
    ("<p>One short line.<p>And another.", "One short line.\nAnd another."), ("<div><h1>Only a head</h1></div><footer>no</footer>", "Only a head"),
    (f"<article><p>{LONG}<div class=disqus_thread>no</div><p>end</article>", f"{LONG.strip()}\nend"),
    ("<article>Let <math><mi>x</mi><annotation>no</annotation></math> be <object>a plug-in</object>.</article>", "Let x be a plug-in."),
    (f"<main><p>{LONG}</main><div>{LONG}{LONG}{LONG}</div>", LONG.strip()),
    (f"<article class='post comments-open'><p>{LONG}</article>", LONG.strip()), (f"<article hidden><p>{LONG}</article>", LONG.strip()),
])
def test_the_article_is_not_lost(page, text):
    assert extract.main_text(page) == text


# Three page families that mark nothing, with the text that a reader sees as the article.
def wiki(n):
    body = "".join(f"<h2>Part {i}</h2><p>{LONG}{i}</p><ul><li>item {i}</li><li>next</li></ul>" for i in range(n))
    page = f"<div id=mw-head><ul class=menu><li><a href=/>Main</a></ul></div><div id=bodyContent>{body}</div><div id=footer-info class=footer>{LONG}</div>"
    return page, "\n".join(f"Part {i}\n{LONG.strip()} {i}\nitem {i}\nnext" for i in range(n))


def forum(n):
    posts = "".join(f"<tr><td class=user><a href=u{i}>user{i}</a></td><td><div class=text>{LONG}{i}</div></td></tr>" for i in range(n))
    return f"<form><input></form><table>{posts}</table><div class='pagination'><a href=2>2</a></div>", "\n".join(f"{LONG.strip()} {i}" for i in range(n))


def news(n):
    body = "".join(f"<p>{LONG}{i}</p>" for i in range(n))
    page = f"<div class=topbar>Sale!</div><div class=story><h1>Head</h1>{body}</div><div class='related-links'><a href=1>{LONG}</a></div><aside>{LONG}</aside>"
    return page, "Head\n" + "\n".join(f"{LONG.strip()} {i}" for i in range(n))


@pytest.mark.parametrize("family", [wiki, forum, news])
@pytest.mark.parametrize("n", [1, 2, 30])
def test_other_families_of_pages(family, n):
    page, text = family(n)
    assert extract.main_text(page) == text


# ---- pieces


def odd_texts() -> list[str]:
    random.seed(3)
    out = ["", " ", "   a", "a  b   c    d", " " * 40 + "x" + " " * 17, "日本語 𝄞𝄞 \u0000x\n\n\tq", "de" * 5000, "a" * 3000, "İıſ z", "no break", "�"]
    out += ["".join(random.choice("ab the\n  éß日𝄞.,1") for _ in range(random.randint(0, 40))) for _ in range(1500)]
    bits = ["th", "e", " ", "  ", "in", "g", "er", "1", "\n", "   ", "hello", "world"]
    return out + ["".join(random.choice(bits) for _ in range(random.randint(0, 20))) for _ in range(800)]


def test_pieces_equal_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    texts = odd_texts() + [r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    rows = documents(spark, [None, *texts], extra=True)
    got = {r["doc_id"]: r for r in pieces.encode_documents(rows.unionAll(rows.limit(3))).collect()}
    assert got[0]["ids"] == [] and got[0]["round_trip"]
    for i, t in enumerate(texts, 1):
        r = got[i]
        assert r["ids"] == library.encode(t) and r["n_tokens"] == len(r["ids"]) and r["text"] == library.decode(r["ids"])
        assert r["round_trip"] and r["text_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    assert pieces.encode_documents(rows.limit(0)).count() == 0


def test_marks_in_the_text_and_broken_bytes_follow_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    with open(pieces.model_path(), "rb") as file:
        machine = pieces.Transducer(file.read())
    for t in ["▁▁ a▁b", "▁", "x▁y"]:
        assert machine.encode(t) == library.encode(t) and machine.decode(machine.encode(t)) == library.decode(library.encode(t))
    broken = [machine.bytes[0xE6], machine.bytes[0x41], machine.bytes[0xE6], machine.bytes[0x97]]
    assert machine.decode(broken) == bytes([0xE6, 0x41, 0xE6, 0x97]).decode(errors="replace")


def unigram_model(words: dict[str, float]) -> bytes:
    def field(number: int, data: bytes) -> bytes:
        return bytes([number << 3 | 2, len(data)]) + data

    def piece(text: str, score: float, kind: int) -> bytes:
        return field(1, field(1, text.encode()) + bytes([2 << 3 | 5]) + struct.pack("<f", score) + bytes([3 << 3, kind]))

    rows = [piece("<unk>", 0, pieces.UNKNOWN)] + [piece(f"<0x{b:02X}>", 0, pieces.BYTE) for b in range(256)]
    rows += [piece(w, s, pieces.NORMAL) for w, s in words.items()]
    return b"".join(rows) + field(2, bytes([3 << 3, pieces.UNIGRAM])) + field(3, bytes([3 << 3, 1, 4 << 3, 0]))


def test_a_unigram_model_takes_the_best_of_all_paths():
    words = {"▁": -3.0, "a": -4.0, "b": -4.5, "c": -5.0, "ab": -6.0, "bc": -5.5, "▁a": -5.0, "abc": -12.0, "ca": -7.25, "▁ab": -8.125}
    machine = pieces.Transducer(unigram_model(words))
    score = lambda ids: sum(machine.scores[i] if machine.kinds[i] == pieces.NORMAL else 0 for i in ids)

    def best(text: str) -> float:
        if not text:
            return 0.0
        return max((words[text[:n]] + best(text[n:]) for n in range(1, 5) if text[:n] in words), default=float("-inf"))

    random.seed(5)
    for _ in range(200):
        text = "".join(random.choice("abc ") for _ in range(random.randint(1, 9)))
        ids = machine.encode(text)
        assert machine.decode(ids) == text and abs(score(ids) - best("▁" + text.replace(" ", "▁"))) < 1e-6
    assert machine.decode(machine.encode("aéb")) == "aéb"
