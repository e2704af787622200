"""HTML, token shards, packing, URL filters and WARC against brute force, with awkward rows."""

import base64
import collections
import gzip
import hashlib
import os
import random
import zlib
from html.parser import HTMLParser

import numpy as np
import pytest

from tidelock.llm import html, packing, tokens, urlfilter, warc
from tidelock.llm.shared import Scratch

tokenizers = pytest.importorskip("tokenizers")
SMALL = "/root/testdata/sf0.001"
TEXTS = [None, "", " ", "\n\n a  b\tc ", "Hello world, it's 12 o'clock", "naïve é 漢字　x\u2003y\x85z", "word " * 3000, "a", "a", "<|endoftext|> x", "hi <|endoftext|> x<|startoftext|>", "<|STARTOFTEXT|> <| y", "tail  "]


def ids_of(name, texts):
    t = tokenizers.Tokenizer.from_file(tokens.vocabulary_path(name))
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("shard_ids", [tokens.SHARD_IDS, 50])
def test_token_shards_round_trip(spark, make_docs, shard_ids):
    rows = [(10 * k - 30, t) for k, t in enumerate(TEXTS)] + [(5, "tie b"), (5, "tie a")]
    random.Random(1).shuffle(rows)
    scratch = Scratch(spark, "t")
    vocabulary = tokens.Vocabulary(spark, tokens.vocabulary_path("byte_bpe_50k.json"))
    manifest = tokens.write_ids(make_docs(rows).repartition(3), vocabulary, 2, f"{scratch.path}/s", scratch, shard_ids)
    got = tokens.read_documents(manifest, f"{scratch.path}/s").orderBy("start").collect()
    # rows of one doc_id stand in the order of a hash of their texts
    ties = [r.ids_crc32 for r in got if r.doc_id == 5]
    rows.sort(key=lambda r: (r[0], r[0] == 5 and ties.index(crc([*ids_of("byte_bpe_50k.json", [r[1]])[0], 2]))))
    at, want = 0, []
    for (i, _), ids in zip(rows, ids_of("byte_bpe_50k.json", [t for _, t in rows])):
        want.append((i, at, len(ids) + 1, crc([*ids, 2])))
        at += len(ids) + 1
    assert [tuple(r) for r in got] == want
    shard = tokens.Shard(f"{scratch.path}/s", manifest.first().path)
    assert shard.document(0)[-1] == 2 and shard.head["id_bytes"] == 2


def test_token_shards_of_null_ids_and_empty_tables(spark, make_docs):
    scratch, vocabulary = Scratch(spark, "t"), tokens.Vocabulary(spark, tokens.vocabulary_path("byte_bpe_50k.json"))
    for rows in ([(None, "a"), (None, "b"), (3, "c")], []):
        folder = f"{scratch.path}/n{len(rows)}"
        got = tokens.read_documents(tokens.write_ids(make_docs(rows), vocabulary, 2, folder, scratch), folder).collect()
        assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)


@pytest.mark.parametrize(("values", "limit"), [([], 1), ([0], 1), ([5], 10**12), ([0, 0, 3, 3, 9], 10), (sorted(random.Random(2).choices(range(10**6), k=4000)), 10**6), (list(range(3000)), 3000)])
def test_elias_fano(values, limit):
    e, used = tokens.EliasFano.from_bytes(memoryview(tokens.EliasFano.of(np.array(values, np.int64), limit).to_bytes() + b"tail"))
    assert e.select_many(np.arange(len(values))).tolist() == values == [e.select(k) for k in range(len(values))]
    if len(values) > 1000:
        assert 8 * used < len(values) * (3 + np.log2(limit / len(values) + 1)) + 600
    with pytest.raises(IndexError):
        e.select(len(values))


def test_tokens_of_added_tokens_and_of_long_words_alike(spark):
    # two words whose sums of powers of any odd number are equal modulo 2**64
    thue = "".join("ab"[bin(k).count("1") % 2] for k in range(2048))
    texts = [f"x {thue} y {thue.translate(str.maketrans('ab', 'ba'))} z", "a <|endoftext|>b", "<|startoftext|>", "end<|endoftext|>", "<|EndOfText|> c", "plain"]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        encoder = tokens.Encoder(open(tokens.vocabulary_path(name), encoding="utf-8").read(), tokens.CUTS[name])
        data = [t.encode() for t in texts]
        ids, at = encoder.encode(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == ids_of(name, texts)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_tokens_of_odd_texts(name):
    rng = random.Random(9)
    parts = [" ", "  ", "\n", "\t", "a", "b", "é", "漢", "\x01", "\x00", "Ġ", "!", ".", "'s", "1", "\u0301", "Σ", "ς", "'", "😀", "\u200d", "\x1c", "\x85", "\u3000", "<|", "<|endoftext|>"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(1500)]
    encoder, data = tokens.Encoder(open(tokens.vocabulary_path(name), encoding="utf-8").read(), tokens.CUTS[name]), [t.encode() for t in texts]
    ids, at = encoder.encode(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == ids_of(name, texts)


def test_token_pieces_with_one_hash_are_told_apart(monkeypatch):
    name, whole = "byte_bpe_50k.json", tokens.tv.span_hashes
    encoder = tokens.Encoder(open(tokens.vocabulary_path(name), encoding="utf-8").read(), tokens.CUTS[name])
    monkeypatch.setattr(tokens.tv, "span_hashes", lambda b, s, e, seed=0: whole(b, s, e, seed) if seed else whole(b, s, e) & np.uint64(3))
    texts = ["one two three four five six", "seven", "two eight nine"] * 2
    data = [t.encode() for t in texts]
    for _ in range(2):
        ids, at = encoder.encode(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == ids_of(name, texts)


def test_reading_shards_looks_up_few_places_at_a_time(spark, make_docs, monkeypatch):
    scratch, asked = Scratch(spark, "t"), []
    vocabulary = tokens.Vocabulary(spark, tokens.vocabulary_path("byte_bpe_50k.json"))
    manifest = tokens.write_ids(make_docs([(k, f"text {k}") for k in range(50)]).coalesce(1), vocabulary, 2, f"{scratch.path}/s", scratch)
    many = tokens.EliasFano.select_many
    monkeypatch.setattr(tokens.EliasFano, "select_many", lambda self, i: asked.append(len(i)) or many(self, i))
    monkeypatch.setattr(tokens, "READ_DOCS", 4)
    rows = [r for b in tokens._read(iter([tokens.pa.RecordBatch.from_pylist([r.asDict() for r in manifest.collect()])]), f"{scratch.path}/s") for r in b.to_pylist()]
    assert sorted(r["doc_id"] for r in rows) == list(range(50)) and 0 < max(asked) <= 4


def check_packing(rows, texts, name, end, room):
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= room
    assert set(by_sequence) == set(range(len(by_sequence)))
    for i, ids in zip(texts, ids_of(name, texts.values())):
        ids, at = [*ids, end], 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), crc(ids[at : at + p.length]))
            at += p.length
        assert at == len(ids)
    return len(by_sequence)


@pytest.mark.parametrize("room", [2048, 16])
def test_packing(spark, make_docs, room):
    rng = random.Random(3)
    texts = dict(enumerate(TEXTS + [" ".join(rng.choice(["tide", "mark", "lock", "xq"]) for _ in range(rng.randrange(1, 90))) for _ in range(150)]))
    vocabulary = tokens.Vocabulary(spark, tokens.vocabulary_path("word_bpe_49k.json"))
    rows = packing.pack(make_docs(list(texts.items())).repartition(4), vocabulary, 1, Scratch(spark, "t"), room).collect()
    sequences = check_packing(rows, texts, "word_bpe_49k.json", 1, room)
    total = sum(r.length for r in rows)
    assert sequences <= 1.05 * total / room + 2
    assert packing.pack(make_docs([]), vocabulary, 1, Scratch(spark, "t"), room).count() == 0


def test_packing_keeps_ids_and_repeated_rows(spark, make_docs):
    vocabulary = tokens.Vocabulary(spark, tokens.vocabulary_path("word_bpe_49k.json"))
    rows = packing.pack(make_docs([(1, "a b c"), (1, "a b c"), (None, "d")]), vocabulary, 1, Scratch(spark, "t"), 8, with_ids=True)
    placed = rows.collect()
    sizes = {s: sum(r.length for r in placed if r.sequence_id == s) for s in {r.sequence_id for r in placed}}
    assert len(placed) == 3 and {r.sequence_id: len(r.ids) // 4 for r in packing.sequences(rows).collect()} == sizes
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in placed)


def test_shortest_pack_first_counts_every_piece():
    rng = np.random.default_rng(4)
    counts = np.concatenate(([0], rng.integers(0, 50, 64)))
    used = np.zeros_like(counts)
    for n, lengths in packing.shortest_pack_first(counts, 64):
        assert sum(lengths) <= 64 and lengths == sorted(lengths, reverse=True)
        np.add.at(used, lengths, n)
    assert (used == counts).all()


RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"), ("block", "a.example.net/en/x"), ("block", "org/"), ("allow", "example.com/")]


def judge(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(r), r, v) for v, r in rules if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
    best = min(fits, key=lambda f: (-f[0], f[1]), default=None)
    return host, path, best and best[1], best[2] if best else "allow"


@pytest.mark.parametrize("per_sweep", [20_000, 2])
def test_url_filters(spark, per_sweep):
    rng = random.Random(6)
    urls = [None, "", "nothing", "http://", "https://NET", "http://net/", "http://x.net?q=/en/", "//net/", "http://a.example.net/en/x#y", "http://xexample.net/en/", "HTTP://ORG/fr/", "http://org/fr", "http://u@example.com:80/de/", "http://é.example.com/de/ü", "a://b://example.net/en/"]
    hosts, paths = ["net", "example.net", "a.example.net", "b.a.example.net", "example.com", "www.Example.com", "org", "x.org", "gorg", "example.network"], ["", "/", "/en/", "/en/x", "/en/xy", "/de/", "/de", "/fr/1", "/frx"]
    urls += [f"http://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?a=/b', '#c'])}" for _ in range(200)]
    table = spark.createDataFrame([(k // 2 if k < 4 else k, u) for k, u in enumerate(urls)], "page_id long, url string").selectExpr("*", "'z' as rule", "1 as block", "'v' as verdict", "2 as height")
    rules = urlfilter.rule_table(spark, RULES + RULES[:2])
    got = sorted((str(tuple(r)) for r in urlfilter.judge_urls(table, rules, rules_per_sweep=per_sweep).collect()))
    assert got == sorted(str((k // 2 if k < 4 else k, *judge(u, RULES))) for k, u in enumerate(urls))
    assert urlfilter.judge_urls(table.limit(0), rules).count() == 0
    assert {r.verdict for r in urlfilter.judge_urls(table, rules.limit(0), default="block").collect()} == {"block"}


def test_url_rules_with_odd_paths_and_ties(spark):
    rules = [("block", "net/"), ("allow", "evil.com/abcdef"), ("block", "a.org/bbb"), ("allow", "aa.a.org/"), ("allow", "org/\x00net.zz"), ("block", "x.com/\x01"), ("allow", "com/")]
    urls = ["http://evil.com/\x00net.zz", "http://evil.com/\x00net.zzz/", "http://aa.a.org/bbb", "http://a.org/\x00net.zz", "http://x.com/\x01\x02", "http://x.com/\x02", "http://b.net/\x00"]
    table = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in urlfilter.judge_urls(table, urlfilter.rule_table(spark, rules)).collect()}
    assert got == {k: judge(u, rules)[2:] for k, u in enumerate(urls)}
    # of equally long rules the first by text
    assert got[2] == ("a.org/bbb", "block") and got[0] == ("com/", "allow")


def page_rows():
    rng = random.Random(8)
    same = "<p>same payload</p>"
    rows = [(1, "http://a/1", None), (2, None, ""), (3, "http://a/3", same), (9, "http://a/9\r\nX: y", same), (4, "http://a/4", same), (9, "http://a/9", same), (None, "http://a/n", same), (5, "http://é/5", "ü\x00" * 50000)]
    return rows + [(100 + k, f"http://b/{k}", "".join(rng.choices("abcdef<> ", k=rng.randrange(1, 4000)))) for k in range(60)]


@pytest.mark.parametrize(("least", "split"), [(0, 1 << 20), (0, 777), (1, 5000)])
def test_warc_round_trip(spark, least, split):
    rows, scratch = page_rows(), Scratch(spark, "t")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as key", "'s' as salt", "2 as response").repartition(3)
    manifest = warc.write_archives(pages, f"{scratch.path}/w", scratch, least_bytes=least, file_bytes=20_000)
    got = warc.read_archives(manifest, f"{scratch.path}/w", split_bytes=split, with_payload=True).collect()
    top = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= least:
            top[h or ""] = max(top.get(h or "", i), i)
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        refers = top.get(h or "") if i is not None and top.get(h or "", i) != i else None
        want.append((str(i), len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if refers is None else "revisit", str(refers), b"" if refers is not None else data))
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to), bytes(r.payload)) for r in got) == sorted(want)
    assert len({(r.path, r["at"]) for r in got}) == len(rows)
    assert warc.read_archives(warc.write_archives(pages.limit(0), f"{scratch.path}/e", scratch), f"{scratch.path}/e").count() == 0


def test_warc_members_are_ordinary_gzip_and_false_magic_is_passed_over():
    member = lambda k, body: gzip.compress(warc._record("response", k, "u", body, warc.base32_sha1(body), len(body), None))
    noise = warc.MAGIC * 40 + gzip.compress(b"no record")
    data = member(1, b"x") + noise + member(2, warc.MAGIC * 500) + b"\x1f\x8b" + member(3, b"")

    class File:
        def read_at(self, n, at):
            return data[at : at + n]

    for step in (len(data), 64, 7):
        found = [c for s in range(0, len(data), step) for _, c in warc.members(File(), s, min(s + step, len(data)), len(data))]
        assert [warc._page(warc.parse(c)[0]["warc-record-id"]) for c in found] == [1, 2, 3]


def main_text(page):
    found = html.blocks(page)
    keep = html.default_tree().predict(html.features(found)) if found else []
    return [b.text for b, good in zip(found, keep) if good]


NAV = '<nav><ul><li><a href="/x">Start</a></li><li><a href="/y">News</a></li></ul></nav>'
LONG = "The lamp on the pier burned all night, and at dawn the boats came back with less than they had hoped for."


def test_html_blocks_decode_and_join():
    page = f"<!DOCTYPE html><html><head><title>No &amp; title</title><style>p{{x:'</p>'}}</style><script>var a = \"<p>no</p>\";</script></head><body>{NAV}<article><h1>On&nbsp;lamps &lt;1&gt;</h1><p>One  <b>bo</b>ld\n word<br>next</p><p>{LONG}<p>Oil.<!-- <p>no</p> --><ul><li>a&#233;<li>b</ul></article>"
    assert main_text(page) == ["On lamps <1>", "One bold word next", LONG, "Oil.", "aé", "b"]


@pytest.mark.parametrize("beside", [f'<div class="ad">{LONG}</div>', f"<aside><p>{LONG}</p></aside>", f"<footer>{LONG}</footer>", f"<form><p>{LONG}</p></form>", f'<section id="comments"><p>{LONG}</p></section>', f'<div class="cookie-notice">{LONG}</div>', f"<header><p>{LONG}</p></header>", f'<div class="sidebar"><p>{LONG}</p></div>', NAV])
def test_html_leaves_out_what_stands_beside(beside):
    assert main_text(f"<html><body>{beside}<article><h1>Piers</h1><p>{LONG}</p><p>Calm.</p></article>{beside}</body></html>") == ["Piers", LONG, "Calm."]


@pytest.mark.parametrize("head", ["<head><title>T</title>", "<head><title>T</title></head>", '<head><meta charset="utf-8"><style>p{}</style><body>', ""])
def test_html_head_ends_with_or_without_its_tag(head):
    page = f"<html>{head}<article><header><h1>On piers</h1></header><p>{LONG}</p><section><header><h2>Oil</h2></header><p>{LONG}</p></section></article></html>"
    assert main_text(page) == ["On piers", LONG, "Oil", LONG]
    assert [b.main for b in html.blocks(page)] == [True] * 4


def test_html_formulas_and_media_are_inline_text():
    formula = "<math><semantics><mrow><msup><mi>x</mi><mn>2</mn></msup><mo>=</mo><mn>4</mn></mrow><annotation encoding='tex'>x^2 = 4</annotation></semantics></math>"
    for inner, text in ((formula, "x2=4"), ('<object data="a"><param name="b">a map</object>', "a map"), ("<canvas>a chart</canvas>", "a chart"), ('<video><source src="a"><track src="b">a film</video>', "a film"), ("<audio>a song</audio>", "a song")):
        assert main_text(f"<html><body>{NAV}<article><h1>Piers</h1><p>{LONG} Here {inner} stands. {LONG}</p></article>") == ["Piers", f"{LONG} Here {text} stands. {LONG}"]


def test_html_held_out_pages():
    x, y = html.sample_table()
    right = total = 0
    for k in range(len(html.PAGES)):
        tree = html.train_tree(*html.sample_table([p for i, p in enumerate(html.PAGES) if i != k]))
        fx, fy = html.sample_table([html.PAGES[k]])
        right, total = right + int((tree.predict(fx) == fy).sum()), total + len(fy)
    assert right / total > 0.85 and (html.default_tree().predict(x) == y).mean() > 0.99


def test_html_of_awkward_pages(spark):
    rows = [(1, "u", None), (1, "u", ""), (2, None, "plain text without any tag " * 20), (3, "u", "<article><p>cut off in <b"), (None, "u", "<article><p a='\"<>'>x</p>" + "<div>" * 3000 + "deep"), (4, "u", '<p class="' * 2000), (5, "u", "<script>never closed")]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text")).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert {r.page_id: r.text for r in got if r.page_id in (2, 3)} == {2: " ".join(["plain text without any tag"] * 20), 3: "cut off in <b"}
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


class TreeReader(HTMLParser):
    """Block texts by building the page's tree first."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = ("root", None, [])

    def handle_starttag(self, tag, attrs):
        node = (tag, self.at, [])
        self.at[2].append(node)
        if tag not in html.VOID:
            self.at = node

    def handle_endtag(self, tag):
        node = self.at
        while node and node[0] != tag:
            node = node[1]
        if node and tag not in html.VOID:
            self.at = node[1]

    def handle_data(self, data):
        self.at[2].append(data)

    def texts(self):
        out, held = [], []

        def flush():
            if text := " ".join("".join(held).split()):
                out.append(text)
            held.clear()

        def walk(node):
            tag, _, inside = node
            if tag in html.RAW:
                held.append(" " * (tag in ("select", "svg", "iframe", "textarea")))
                return
            block = tag not in html.INLINE
            if block:
                flush()
            held.append(" " * (tag == "br"))
            for x in inside:
                held.append(x) if isinstance(x, str) else walk(x)
            if block:
                flush()

        walk(self.root)
        flush()
        return out


ODD_PAGES = [
    "<article><p>One two<script>x('<p>')</script> three</p><p>a <svg><path d='m'/></svg>b <math><mi>x</mi><mo>=</mo><mn>2</mn></math> c</p></article>",
    "<div>text <style>p {}</style>goes on<p>new <b>bold</b>,<br>line</p>tail &amp; &#233;</div>",
    "<ul><li>one</li><li>two <a href='#'>link</a></li></ul><table><tr><td>1</td><td>2</td></tr></table>",
]


def test_html_blocks_are_those_of_the_tree():
    import pyarrow.parquet as pq

    pages = ODD_PAGES + [fragment for page in html.PAGES for fragment in ["".join(f for _, f in page)]]
    if os.path.isdir(SMALL):
        pages += [h for h in pq.read_table(f"{SMALL}/pages.parquet", columns=["html"]).column(0).to_pylist() if h]
    for page in pages:
        reader = TreeReader()
        reader.feed(page)
        reader.close()
        assert [b.text for b in html.blocks(page)] == reader.texts()


@pytest.mark.parametrize(("name", "kept"), [("social-policy", True), ("alert-history", True), ("main-story sidebar-none", True), ("post-reply", True), ("comment-list", False), ("share-buttons", False), ("sidebar", False), ("post-comments", False)])
def test_html_class_names_count_by_their_heads(name, kept):
    text = "A paragraph of main text that tells readers of the plan for the new bridge and what it will cost the town."
    page = f"<nav><a href=x>Home</a></nav><article><h1>Title</h1><p>{text}</p><div class='{name}'><p>{text} Twice.</p><p>{text} Thrice.</p></div></article>"
    found = html.blocks(page)
    left = [b.text for b, good in zip(found, html.default_tree().predict(html.features(found))) if good]
    assert left == ["Title", text] + [f"{text} Twice.", f"{text} Thrice."] * kept
