"""Registered queries against SQL, libraries and brute force over whole small tables."""

import hashlib
import re
import zlib
from html import unescape
from pathlib import Path

import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from matchlens.llm import bpe, simhash
from matchlens.llm.oracle import ORACLE
from matchlens.llm.queries import QUERIES
from workloads.check import connect, spark_rows, sql_rows

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are absent")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.fixture(scope="module")
def texts(connection):
    return dict(connection.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_path())


def rows_of(spark, name):
    return {r["doc_id"]: r for r in QUERIES[name](spark, FOLDER).collect()}


@pytest.mark.parametrize("name", list(ORACLE))
def test_sql(spark, connection, name):
    names, rows = spark_rows(QUERIES[name](spark, FOLDER))
    expected_names, expected = sql_rows(connection, ORACLE[name])
    assert names == expected_names and rows and rows == expected


def brute_components(prints):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if bin(prints[a] ^ prints[b]).count("1") <= simhash.MOST:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op1(spark, texts):
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    expected = brute_components(prints)
    found = rows_of(spark, "op1_simhash")
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in found.items()} == {i: (f"{prints[i]:016x}", expected[i]) for i in texts}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def plain_spans(text):
    out = [("email", m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", m.span()))
    order = ["email", "ip", "card", "phone"]
    return sorted(out, key=lambda s: (s[1][0], order.index(s[0])))


def test_op3(spark, texts):
    for i, row in rows_of(spark, "op3_pii").items():
        expected = plain_spans(texts[i])
        shown = [f"{kind}:{a}:{b}" for kind, (a, b) in expected]
        assert row["base_sha256"] == hashlib.sha256(",".join(shown).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[0] == k for s in expected) for k in ("email", "ip", "card", "phone")]
        assert set(shown) <= set(row["spans"].split(","))


def test_op4(spark, connection):
    pages = connection.execute("SELECT page_id, html FROM pages").fetchall()
    found = {r["page_id"]: r for r in QUERIES["op4_html"](spark, FOLDER).collect()}
    for page, html in pages:
        article = html[html.index("<article>") + 9 : html.index("</article>")]
        expected = " ".join(unescape(re.sub("</?(p|br|h1)>", " ", article).replace("<b>", "")).split())
        assert (found[page]["text"], found[page]["n_chars"]) == (expected, len(expected))


def test_op5(spark, texts):
    found = rows_of(spark, "op5_quality")
    for i, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        grams = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        marked = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(5)} if len(set(grams)) < len(grams) else set()
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        counts = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked))
        failed = len(words) < 10 or 100 * len(marked) > 20 * len(words)
        row = found[i]
        assert tuple(row)[1:6] == counts and row["base_failed"] == failed and not (failed and row["kept"])


def test_op7_and_op9(spark, texts, library):
    encoded = rows_of(spark, "op7_bpe")
    counted = rows_of(spark, "op9_token_counts")
    for i, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        back = library.decode(ids, skip_special_tokens=False)
        assert tuple(encoded[i])[1:] == (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
        assert tuple(counted[i])[1:] == (len(text.encode()), len(ids), len(ids) > 512)


def test_op8(spark, texts):
    rows = QUERIES["op8_sharding"](spark, FOLDER).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {i: (len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in texts.items()}
    slots, sizes = {}, {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
    assert set(slots) <= set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    # Each of the six cuts is off by one row at most.
    largest = max(r["size"] for r in rows)
    mean = sum(sizes.values()) / 40
    assert all(abs(s - mean) <= 2 * largest for s in sizes.values())
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}


def test_pipeline(spark, connection, texts, library):
    from matchlens.llm import pii, quality
    from matchlens.llm.decontaminate import find_leaks

    found = {r["doc_id"]: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {r["doc_id"] for r in quality.judge(docs).filter("kept").select("doc_id").collect()}
    roots = brute_components({i: plain_fingerprint(texts[i]) for i in kept})
    kept = {i for i in kept if roots[i] == i}
    leaks = find_leaks(docs, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).filter("contaminated").select("doc_id").collect()
    kept -= {r["doc_id"] for r in leaks}
    assert set(found) == kept
    for i in kept:
        assert found[i]["ids"] == library.encode(pii.redacted(texts[i]), add_special_tokens=False).ids
