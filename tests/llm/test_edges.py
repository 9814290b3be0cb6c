"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from matchlens.llm import bpe, components, decontaminate, html_text, pii, quality, sharding, simhash, token_counts, url_filter, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or return.
CLASHING = ("key", "digest", "fp", "words", "n_tokens", "shard", "slot", "size", "spans", "kept", "host", "winner", "part", "component", "url_key")


def prose(seed, n=60):
    chosen = random.Random(seed)
    return " ".join(chosen.choice("the of and to in a is that for it as stone river window market letter garden winter paper".split()) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def docs(spark):
    long_text = " ".join(prose(k) for k in range(200))
    rows = [
        (1, prose(1), "en", "a", 1), (2, prose(1), "en", "a", 1), (2, prose(1), "en", "a", 1), (3, None, None, None, None), (None, prose(4), "xx", "a", 2),
        (None, prose(4), "xx", "a", 2), (6, "", "fr", "b", 0), (7, long_text, "en", "b", 9), (8, "x" * 100_000, "en", "b", 9), (9, "1." * 50_000, "de", "b", 9),
        (10, " \n\t ", "en", "b", 4), (11, "mail a@b.co now <|endoftext|>", "en", "b", 4),
    ]
    frame = spark.createDataFrame(rows, DOCS)
    return frame.withColumns({name: F.lit(name) for name in CLASHING}).cache()


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, " ".join(prose(7).split()[5:25])), (1, "Garden, PAPER"), (2, None), (3, ""), (None, prose(1)), (4, prose(2))]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, None, None), (None, "http://a.com/x", ""), (2, "no scheme", "<p>text"), (2, "no scheme", "<p>text"), (3, "HTTP://WWW.A.com:80/x/?utm_source=1#top", "<b>" * 5000)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({name: F.lit(1) for name in CLASHING})


def operators(spark, docs, items, pages):
    rules = url_filter.rules_frame(spark, [("com", "/", "allow"), (None, "/", "block"), ("", "/", "block")])
    return {
        "simhash": (docs, simhash.near_copies),
        "leaks": (docs, lambda df: decontaminate.find_leaks(df, items)),
        "pii": (docs, pii.find_spans),
        "quality": (docs, quality.judge),
        "bpe": (docs, bpe.round_trip),
        "encode": (docs, bpe.encode),
        "counts": (docs, token_counts.count_tokens),
        "shards": (docs, lambda df: sharding.shard(df, shards=4)),
        "html": (pages, html_text.extract),
        "urls": (pages, lambda df: url_filter.judge(df, rules)),
    }


NAMES = ["simhash", "leaks", "pii", "quality", "bpe", "encode", "counts", "shards", "html", "urls"]


@pytest.mark.parametrize("name", NAMES)
def test_one_row_for_each_and_none_for_none(spark, docs, items, pages, name):
    frame, operator = operators(spark, docs, items, pages)[name]
    found = operator(frame)
    key = frame.columns[0]
    assert sorted(str(r[0]) for r in found.select(key).collect()) == sorted(str(r[0]) for r in frame.select(key).collect())
    empty = operator(frame.limit(0))
    assert empty.columns == found.columns and empty.count() == 0


def test_components_of_chains_stars_and_ties(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(5, i) for i in range(200, 260)] + [(5, 200), (5, 5), (None, 5)]
    pairs = chain + star + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    found = {r.node: r.component for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    roots = {n: n for p in pairs if None not in p for n in p}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if a is not None and roots[a] != roots[b]:
                roots[a] = roots[b] = min(roots[a], roots[b])
                changed = True
    assert found == roots


def test_dense_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "DENSE", 4)
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(3)]
    prints = {b for x in base for b in [x, *(x ^ sum(1 << k for k in rng.sample(range(64), rng.choice((1, 2, 3, 4, 6)))) for _ in range(60))]}
    frame = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    links = simhash.links(frame)
    found = {r.node: r.component for r in components.components(links).collect()}
    ids = sorted(simhash._signed(p) for p in prints)
    root = {i: i for i in ids}
    for _ in range(10):
        for n, a in enumerate(ids):
            for b in ids[n + 1 :]:
                if bin((a ^ b) & (2**64 - 1)).count("1") <= 3:
                    root[a] = root[b] = min(root[a], root[b])
    assert {i: found.get(i, i) for i in ids} == root


def test_pivots_discard_no_close_pair():
    rng = np.random.default_rng(4)
    near = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    fps = np.concatenate([near, near ^ np.uint64(0b111), near ^ np.uint64(0b11110000)])
    found = {frozenset((int(a), int(b))) for x, y in simhash.close_pairs(fps, np.zeros(len(fps))) for a, b in zip(x, y)}
    expected = {frozenset((i, j)) for i in range(len(fps)) for j in range(i) if bin(int(fps[i] ^ fps[j])).count("1") <= 3}
    assert found == expected


def test_first_of_each_keeps_one_row(spark, docs):
    kept = simhash.first_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    # 1 and 2 are copies, as are the two without id; 3, 6 and 10 have no words.
    assert sorted(str(i) for i in ids) == sorted(["1", "None", "3", "7", "8", "9", "11"])


def test_short_and_repeated_items(spark, items):
    text = prose(7)
    rows = [(1, text), (2, "a garden paper b"), (3, "garden and paper"), (4, prose(1).upper()), (5, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in decontaminate.find_leaks(frame, items).collect()}
    assert found[1].n_hit >= 20 and found[1].item_ids == ["1"]
    assert (found[2].n_words, found[2].n_hit, found[2].item_ids) == (4, 2, ["1"])
    assert not found[3].contaminated and not found[5].contaminated
    assert found[4].contaminated and found[4].n_hit == found[4].n_words and set(found[4].item_ids) <= {"1"}
    assert {r.doc_id for r in decontaminate.clean(frame.withColumn("digest", F.lit(1)), items).collect()} == {3, 5}


def test_places_are_hashed_and_words_counted_in_compiled_code(spark, items):
    frame = spark.createDataFrame([(1, prose(7))], "doc_id long, text string")
    plan = decontaminate.find_leaks(frame, items)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan
    texts = frame.select("doc_id", decontaminate.words_of(F.col("text")).alias("words"))
    found = decontaminate._fingerprints(texts, [2], lambda h: h % 2 == 0).select("found")
    lambdas = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "lambdafunction" in line]
    assert lambdas and not any("words#" in line for line in lambdas)


def test_windows_of_few_words_equal_brute_force(spark):
    rng = random.Random(2)
    texts = {i: [rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.choice([0, 4, 9, 10, 11, 15, 40]))] for i in range(60)}
    listed = [(i % 7, texts[i][rng.randint(0, 3) :][: rng.choice([4, 9, 10, 12])]) for i in range(0, 60, 4)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    items = spark.createDataFrame([(i, ", ".join(w)) for i, w in listed], "item_id long, text string")
    found = {r.doc_id: r for r in decontaminate.find_leaks(docs, items).collect()}
    for i, words in texts.items():
        hit, ids = set(), set()
        for item, own in listed:
            n = min(len(own), 10)
            for window in [own[k : k + n] for k in range(len(own) - n + 1)] if n else []:
                at = [k for k in range(len(words) - n + 1) if words[k : k + n] == window]
                hit |= {k + j for k in at for j in range(n)}
                ids |= {str(item)} if at else set()
        assert (found[i].n_words, found[i].n_hit, found[i].item_ids) == (len(words), len(hit), sorted(ids))


def test_added_spans_need_checksum_and_context():
    good, bad = "IBAN GB82 WEST 1234 5698 7654 32 please", "IBAN GB83 WEST 1234 5698 7654 32 please"
    assert [s[:3] for s in pii.spans_of(good) if s[0] == "iban"] == [("iban", 5, 32)]
    assert not [s for s in pii.spans_of(bad) if s[0] == "iban"]
    assert [s[0] for s in pii.spans_of("ssn 123-45-6789")] == ["ssn"] and not pii.spans_of("order 123-45-6789")
    assert pii.redacted("to a@b.co, 10.0.0.1") == "to [EMAIL], [IP]" and pii.redacted(None) is None


def test_quality_verdicts(spark):
    rows = [(i, prose(i, 200), "en") for i in range(30)]
    rows += [(100, " ".join(w + "###" for w in prose(5, 200).split()), "en"), (101, " | ".join(f"qz{k}x" for k in range(200)), "en"), (102, "one " * 50, "en")]
    found = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(found[i].kept for i in range(30)) and not any(found[i].kept for i in (100, 101, 102))
    assert found[102].base_failed and not found[100].base_failed


def test_encoding_equals_the_library(spark):
    library = Tokenizer.from_file(bpe.default_path())
    rng = random.Random(1)
    parts = ["a", " ", "  ", "\n", "the", "'s", "1", "²", "é", "日本", "　", "\x85", "\x1c", "<|endoftext|>", "<|endof", "!", "՘", "😀", "aaaa", "\xa0", "\t", "ſ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    own, count = bpe.encoder(bpe.default_path()), token_counts.counter(bpe.default_path())
    for text, raw in zip(texts, own.encode(texts)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(raw, "<u4").tolist() == ids and count.count(text) == len(ids)
        assert own.decode(np.array(ids, dtype=np.int64)) == library.decode(ids, skip_special_tokens=False)
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:50])], "doc_id long, text string")
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(frame)).collect()}
    assert back == dict(enumerate(texts[:50]))


def test_unbroken_texts_equal_the_library_in_like_time():
    library = Tokenizer.from_file(bpe.default_path())
    rng = random.Random(6)
    unbroken = {
        "cjk": "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(40_000)),
        "thai": "".join(chr(rng.randrange(0xE01, 0xE3A)) for _ in range(40_000)),
        "base64": "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(100_000)),
        "letters": "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000)),
    }
    own, count = bpe.encoder(bpe.default_path()), token_counts.counter(bpe.default_path())
    for text in unbroken.values():
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == ids and count.count(text) == len(ids)
    for name in ("letters", "cjk"):
        raw = unbroken[name].encode()
        looked = sum(len(list(own.trie.candidates(raw, end))) for end in range(1, 2000))
        assert looked / 2000 < 12  # lengths tried for each byte of the text, of up to 128


def test_memories_are_bounded_by_size(monkeypatch):
    own, count = bpe.Encoder(bpe.default_path()), token_counts.Counter(bpe.default_path())
    own.encode(["長" * 500, "b" * 5000, "short words stay"])
    count.count("長" * 500 + " short")
    assert own.memory and count.memory and max(map(len, [*own.memory, *own.pieces, *count.memory, *count.pieces])) <= bpe.SHORT
    assert own.sizes[0] == sum(len(k) + len(v) for k, v in own.memory.items())
    monkeypatch.setattr(bpe, "REMEMBERED_SIZE", 10)
    own.encode(["other words"])
    assert set(own.memory) == {"other", " words"}


def test_shards_of_one_source_and_of_copies(spark):
    rows = [(i, "same text" if i % 3 == 0 else "t" * (i % 50), "en", "hot", i % 50) for i in range(3000)]
    made = sharding.shard(spark.createDataFrame(rows, DOCS), target_bytes=12_000).collect()
    sizes = {}
    for r in made:
        sizes[r.shard] = sizes.get(r.shard, 0) + r["size"]
    mean = sum(sizes.values()) / len(sizes)
    assert len(sizes) == -(-sum(sizes.values()) // 12_000) and all(abs(s - mean) < 200 for s in sizes.values())
    assert all(r.text_crc32 == zlib.crc32(rows[r.doc_id][1].encode()) for r in made)


def test_shards_of_identical_rows(spark):
    rows = [(1, "same text", "en", "hot", 9)] * 1000 + [(i, "t" * (i % 50), "en", f"s{i % 9}", i % 50) for i in range(2, 2000)]
    made = sharding.shard(spark.createDataFrame(rows, DOCS), shards=24).collect()
    sizes, slots = dict.fromkeys(range(24), 0), {}
    for r in made:
        sizes[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(made) == len(rows) and all(abs(s - sum(sizes.values()) / 24) < 200 for s in sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sum(1 for s in range(24) if any(r.shard == s and r.doc_id == 1 for r in made)) >= 5


def plain_tree(cells, shards, first, widest, out):
    """Shard of every cell (coordinates, tail, bytes) by cutting sorted lists."""
    if shards == 1 or not cells:
        out.update({(c[0], c[1]): first for c in cells})
        return
    spans = [max(c[0][d] for c in cells) - min(c[0][d] for c in cells) for d in range(len(widest))]
    d = max(range(len(widest)), key=lambda d: (spans[d] / widest[d], -d))
    half, so_far, low = shards // 2, 0, 0
    cells = sorted(cells, key=lambda c: (c[0][d], c[1]))
    target = sum(c[2] for c in cells) * half // shards
    while low < len(cells):
        end = low  # cells of one coordinate and one tail are cut together
        while end < len(cells) and (cells[end][0][d], cells[end][1]) == (cells[low][0][d], cells[low][1]):
            so_far += cells[end][2]
            end += 1
        low = end
        if so_far >= target:
            break
    plain_tree(cells[:low], half, first, widest, out)
    plain_tree(cells[low:], shards - half, first + half, widest, out)


@pytest.mark.parametrize("shards", [1, 2, 7, 40])
def test_cells_are_cut_as_a_plain_tree_cuts_them(spark, shards):
    rng = random.Random(shards)
    cells = {((rng.choice([5, 5, 5, 90, 4000]), rng.randrange(12)), rng.randrange(1 << 48) if n % 3 else n << 32): rng.randrange(1, 400) for n in range(900)}
    expected, plain = {}, [(c, tail, size) for (c, tail), size in cells.items()]
    plain_tree(plain, shards, 0, [max(c[0][d] for c in plain) - min(c[0][d] for c in plain) for d in (0, 1)], expected)
    frame = spark.createDataFrame([(*c, tail, size) for c, tail, size in plain], "c0 long, c1 long, tail long, bytes long")
    found = sharding.grow(frame, sharding._Tables(frame), ["c0", "c1"], shards).collect()
    assert {((r.c0, r.c1), r.tail): r.shard for r in found} == expected and len(found) == len(cells)


def test_pages_without_an_article():
    page = (
        "<html><body class='has-sidebar'><div id=top class=header><a href=/>Home</a></div><ul class=menu><li>One<li>Two</ul><div class=content><h1>Title &amp; more</h1>"
        "<p>First paragraph is here with enough words to be counted as the text of it.<p class='notice'>We use cookies</p><p>a < b and <b>c</b>d&nbsp;e</div>"
        "<div class='comments'><p>I like it a lot, this is what a reader has to say about it all.</p></div><form><input> Subscribe</form><footer>(c) x</footer>"
    )
    assert html_text.main_text(page) == "Title & more First paragraph is here with enough words to be counted as the text of it. a < b and cd e"
    assert html_text.main_text("<article><h1>T</h1><p>x</p><article class='comment'>no</article><p>y</article><aside>z") == "T x y"
    assert html_text.main_text(None) == html_text.main_text("<nav>a</nav><script>if (a < b) '<p>'</script>") == ""


def test_longest_rule_decides(spark):
    rules = url_filter.rules_frame(spark, [("com", "/", "allow"), ("a.com", "/en", "block"), ("www.a.com", "/en/", "allow"), ("a.com", "/en", "block")])
    urls = ["http://a.com/english?x", "https://WWW.A.com/en/1", "x://b.com", "http://ba.com/en/", "a.com/en/", None, "http://a.com:80/en/"]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(frame, rules).collect()}
    assert found == {
        0: ("a.com/en", "block"), 1: ("www.a.com/en/", "allow"), 2: (None, "allow"), 3: ("com/", "allow"), 4: (None, "allow"), 5: (None, "allow"), 6: (None, "allow"),
    }


def record(kind, name, date, *fields, url="http://www.a.com/x/?utm_source=z", body=""):
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", f"WARC-Date: {date}", f"WARC-Target-URI: {url}"]
    line = "HTTP/1.1 200 OK" if kind == "response" else "HTTP/1.1 304 Not Modified"
    return "\r\n".join(head) + "\r\n\r\n" + "\r\n".join([line, *fields]) + "\r\n\r\n" + body


def test_revisits(spark):
    rows = [
        record("response", "r1", "2024-01-01T00:00:00Z", 'ETag: "1"', "Content-Type: text/html", "Set-Cookie: a", "Set-Cookie: b", body="one\r\n\r\nmore"),
        record("response", "r2", "2024-02-01T00:00:00Z", 'ETag: W/"2"', body="two"),
        record("response", "r3", "2024-02-01T00:00:00Z", 'ETag: "3"', body="three"),
        record("revisit", "v0", "2023-12-31T00:00:00Z", 'ETag: "1"'),
        record("revisit", "v1", "2024-01-01T00:00:00Z", 'ETag: "1"'),
        record("revisit", "v2", "2024-01-15T00:00:00Z", 'ETag: W/"1"', "Content-Type: none", "Age: 3", url="https://a.com/x#frag"),
        record("revisit", "v3", "2024-03-01T00:00:00Z", 'ETag: "2"'),
        record("revisit", "v4", "2024-03-01T00:00:00Z", "Age: 3"),
        record("revisit", "v4", "2024-03-01T00:00:00Z", "Age: 3"),
        record("revisit", "v5", "never", "Age: 3"), None, "", "junk",
    ]
    frame = spark.createDataFrame([(r, 1) for r in rows], "record string, type int")
    captures = warc.parse(frame)
    resolved = warc.resolve(captures)
    found = sorted((r.record_id, r.outcome, r.source_id) for r in resolved.collect())
    assert found == [
        ("v0", "missing", None), ("v1", "missing", None), ("v2", "resolved", "r1"), ("v3", "mismatch", "r3"), ("v4", "unverified", "r3"), ("v4", "unverified", "r3"),
    ]
    merged = {r.record_id: r for r in warc.with_bodies(resolved, captures).collect()}
    assert [tuple(h) for h in merged["v2"].headers] == [("content-type", "text/html"), ("set-cookie", "a"), ("set-cookie", "b"), ("etag", 'W/"1"'), ("age", "3")]
    assert merged["v2"].body == "one\r\n\r\nmore" and merged["v3"].body is None and merged["v4"].body == "three"
    assert warc.resolve(captures.limit(0)).count() == 0


def test_captures_far_apart_and_close_together(spark):
    times = ["1990-01-01T00:00:00Z", "2024-01-01T00:00:00.000001Z", "2024-01-01T00:00:00.000003Z", "2060-01-01T00:00:00Z"]
    rows = [record("response", f"r{i}", t, body="x") for i, t in enumerate(times)]
    rows += [record("revisit", "a", "2024-01-01T00:00:00.000002Z"), record("revisit", "b", "2023-01-01T00:00:00Z"), record("revisit", "c", "2070-01-01T00:00:00Z")]
    found = warc.resolve(warc.parse(spark.createDataFrame([(r,) for r in rows], "record string")))
    assert {r.record_id: r.source_id for r in found.collect()} == {"a": "r1", "b": "r0", "c": "r3"}


def test_pipeline_stages_keep_columns(spark, docs, tmp_path):
    spark.createDataFrame([(1, prose(50))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    frame = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, str(tmp_path))
        assert frame.columns == docs.columns
    last = corpus_pipeline.STAGES[-1][1](spark, frame, str(tmp_path))
    assert last.count() == frame.count()
    assert all(stage(spark, docs.limit(0), str(tmp_path)).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_texts_are_encoded_together_by_their_bytes(monkeypatch):
    monkeypatch.setattr(bpe, "TOGETHER_SIZE", 10)
    monkeypatch.setattr(bpe, "TOGETHER", 3)
    texts = ["a" * 4, "b" * 6, None, "c", "d" * 30, "e", "", None, "f"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], names=["key", "text"])
    parts = [p.column(1).to_pylist() for p in bpe.together(batch)]
    assert parts == [["aaaa", "bbbbbb", None], ["c"], ["d" * 30], ["e", "", None], ["f"]]


def test_a_part_of_one_piece_is_remembered_once():
    library = Tokenizer.from_file(bpe.default_path())
    own = bpe.Encoder(bpe.default_path())
    texts = ["stone stonework don't Don't 12ab xé é stone", " stone", "stone's stone", "a  b\n c"]
    for _ in range(2):
        assert [np.frombuffer(r, "<u4").tolist() for r in own.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert " stonework" in own.memory and " stonework" not in own.pieces


def test_only_prefixes_that_a_token_may_follow_are_encoded():
    library = Tokenizer.from_file(bpe.default_path())
    rng = random.Random(11)
    word = "".join(rng.choice("thenaorsi") for _ in range(1200))
    words = [word[:n] for n in (40, 41, 90, 200, 256, 257, 300, 700, 1200)] + ["".join(rng.choice("thenaorsi") for _ in range(12)) for _ in range(500)]
    own = bpe.Encoder(bpe.default_path())
    assert [np.frombuffer(r, "<u4").tolist() for r in own.encode(words)] == [library.encode(w, add_special_tokens=False).ids for w in words]
    looked = 0

    class Ends(dict):
        def get(self, tail, default=None):
            nonlocal looked
            looked += 1
            return super().get(tail, default)

    own.trie.ends = Ends(own.trie.ends)
    try:
        short = set(words[-500:])
        own.trie.encode_all(short)
    finally:
        own.trie.ends = dict(own.trie.ends)
    assert 0 < looked < 0.6 * sum(map(len, short))


def test_a_full_memory_keeps_what_is_asked_for(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    own = bpe.Encoder(bpe.default_path())
    own.encode(["stone river water house forest garden"])
    asked, walk = [], own.trie.encode_all
    monkeypatch.setattr(own.trie, "encode_all", lambda pieces: asked.extend(pieces) or walk(pieces))
    own.encode(["a river lake"])
    assert sorted(asked) == [" lake", "a"] and set(own.memory) == {"a", " river", " lake"}
    assert own.sizes[0] == sum(len(k) + len(v) for k, v in own.memory.items())


def test_a_piece_that_is_a_known_part_is_not_encoded_again(monkeypatch):
    library = Tokenizer.from_file(bpe.default_path())
    own = bpe.Encoder(bpe.default_path())
    own.encode(["stone river forest"])
    asked, walk = [], own.trie.encode_all
    monkeypatch.setattr(own.trie, "encode_all", lambda pieces: asked.extend(pieces) or walk(pieces))
    texts = ["a forest, a river\nstone."]
    assert [np.frombuffer(r, "<u4").tolist() for r in own.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert not {" forest", " river", "stone"} & {*asked, *own.pieces}
