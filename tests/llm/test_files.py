import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from helpers import corpus, documents
from tokenizers import Tokenizer

from trustlens.llm import tokenfile, warc
from trustlens.plans.session import scratch_dir

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


# --- op 3 ---------------------------------------------------------------------


def _ids(text):
    return [*Tokenizer.from_file(TOKENIZER).encode(text or "", add_special_tokens=False).ids, 1]


def _expected(rows, order):
    start = 0
    for doc_id, text in order(rows):
        ids = _ids(text)
        yield doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def _result(spark, path):
    return [tuple(r) for r in tokenfile.read_token_shards(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]


def test_shards_hold_every_document_in_order(spark):
    texts = ["A<|EndOfText|>b it's.", "x <|endoftext|>. Y", "don't!! stop?! ÉTÉ. İ, ΣΑΣ. a.b.c, 3.5, 10,000. \x1c q\xa0r (x).", "...", None, "", ", a .b ,"]
    rows = [(i, t) for i, t in corpus() if i is not None and i != corpus()[3][0]] + [(10_000 - i, t) for i, t in enumerate(texts)]
    path = scratch_dir(spark, "t")
    tokenfile.write_token_shards(documents(spark, rows), path, TOKENIZER, shard_bytes=4000)
    assert sorted(_result(spark, path)) == sorted(_expected(rows, lambda r: sorted(r, key=lambda x: x[0])))
    found = tokenfile.read_token_shards(spark, path)
    assert found.select("path").distinct().count() > 3
    for index in (None, found):
        got = {r.doc_id: r.ids for r in tokenfile.lookup(spark, path, [0, 12, 10_000, 77_777, -5], index).collect()}
        assert got == {k: _ids(dict(rows)[k]) for k in (0, 12, 10_000)}
    assert tokenfile.lookup(spark, path, [77_777], found).collect() == []


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_the_tokenizers_own(monkeypatch, name):
    """Whatever the vocabulary, and with words forgotten all the time."""
    monkeypatch.setattr(tokenfile, "CACHED_WORDS", 60)
    path = public_tokenizers.path(name)
    plain, encoder = Tokenizer.from_file(path), tokenfile.WordEncoder(path, 1)
    texts = [t for _, t in corpus(9)] + ["straße,### ÑANDÚ... été!! niño%%% x1$$$ a&&b c** d,,e É.", "×. ÷! ß? ÿ; \u0301e\u0301. ǅ, ŉ. ª? µ!", "  two  spaces\n\n\tand  lines ", "it's (the) 'end'"]
    for a in range(0, len(texts), 7):
        some = texts[a : a + 7]
        ids, sizes = encoder.encode(pa.array(some, pa.string()))
        want = [[*plain.encode(t or "", add_special_tokens=False).ids, 1] for t in some]
        assert sizes.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def test_words_come_back_from_the_last_generation(monkeypatch):
    monkeypatch.setattr(tokenfile, "CACHED_WORDS", 3)
    encoder = tokenfile.WordEncoder(TOKENIZER, 1)
    learned = []
    learn = encoder.learn
    encoder.learn = lambda words: (learned.extend(words), learn(words))[1]
    first = encoder.encode(pa.array(["ab cd ef gh"]))[0].tolist()
    assert encoder.encode(pa.array(["ab cd ef gh"]))[0].tolist() == first
    assert sorted(learned) == [b"ab", b"cd", b"ef", b"gh"]


def test_repeated_and_null_ids(spark):
    rows = [(5, "b"), (5, "a a"), (5, "b"), (None, "n"), (None, None), (-3, "z"), (2**62, "far")]
    path = scratch_dir(spark, "t")
    tokenfile.write_token_shards(documents(spark, rows), path, TOKENIZER)
    got = _result(spark, path)
    assert Counter((i, n, c) for i, _, n, c in got) == Counter((i, len(_ids(t)), zlib.crc32(np.array(_ids(t), "<u4").tobytes())) for i, t in rows)
    # starts tile the corpus in order of id, nulls first
    at = 0
    for i, start, n, _ in sorted(got, key=lambda r: r[1]):
        assert start == at
        at += n
    assert [i for i, *_ in sorted(got, key=lambda r: r[1])] == [None, None, -3, 5, 5, 5, 2**62]
    assert len(tokenfile.lookup(spark, path, [5]).collect()) == 3


def test_an_empty_corpus_writes_no_shard(spark):
    path = scratch_dir(spark, "t")
    tokenfile.write_token_shards(documents(spark, []), path, TOKENIZER)
    assert _result(spark, path) == []


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_index_is_minimal_and_perfect(n):
    keys = np.unique(np.random.default_rng(n).integers(-(2**62), 2**62, n))
    sizes, bits, slot = tokenfile.build_index(keys)
    assert sorted(slot.tolist()) == list(range(len(keys)))
    assert (tokenfile.find_slots(keys, sizes, bits) == slot).all()
    assert len(bits) <= 8 * max(8, len(keys))


def test_fingerprints_turn_away_other_keys():
    keys = list(range(0, 4000, 2))
    shard = tokenfile.Shard(tokenfile.pack_shard((0, 0), keys, np.arange(2000, dtype=np.uint16), np.ones(2000, int)) + b"\n")
    row, rows = shard.find(np.arange(4000))
    assert rows[::2].tolist() == [1] * 2000 and rows[1::2].sum() == 0
    assert shard.ids(int(row[20])).tolist() == [10]
    # a key that is not there, under the fingerprint of one that is
    forged = shard.slots.copy()
    forged["fingerprint"][:] = tokenfile._fingerprint(np.array([1]))[0]
    shard.slots = forged
    assert shard.find(np.array([1]))[1].tolist() == [0]
    with pytest.raises(ValueError, match="token shard"):
        tokenfile.Shard(b"something else")


# --- op 8 ---------------------------------------------------------------------


def _pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, payload_digest string")


def _warc_expected(rows):
    groups = {}
    for i, _, html in rows:
        p = (html or "").encode()
        groups.setdefault(p, []).append(i)
    for i, _, html in rows:
        p = (html or "").encode()
        ids = [x for x in groups[p] if x is not None]
        first = min(ids) if ids and len(p) >= 100 and len(groups[p]) > 1 else None
        revisit = first is not None and i != first
        yield i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if revisit else "response", first if revisit else None


def test_pages_come_back_from_warc(spark):
    same, other = "<p>é same page</p>" * 10, "x" * 100
    rows = [(9, "http://a/b c", same), (3, "http://a/é", same), (4, None, same), (5, "u", None), (6, "u", ""), (7, "u", "x" * 99), (8, "u", "x" * 99)]
    rows += [(10, "u", other), (11, "u", other), (12, "http://u", "WARC/1.1\r\n\r\n" * 20 + "\r\n\r\n"), (None, "u", other), (None, "u", "only null ids " * 20)]
    rows += [(None, "u", "only null ids " * 20), (20, "u", "long " * 200_000), (21, "\nhttp://x\r\n", "long " * 200_000), (3, "http://again", same)]
    path = scratch_dir(spark, "t")
    got = warc.pages_through_warc(_pages(spark, rows), path)
    assert Counter(tuple(r)[:5] for r in got.collect()) == Counter(_warc_expected(rows))
    uris = {r.page_id: r.uri for r in got.collect()}
    assert uris[9] == "http://a/b%20c" and uris[4] == "urn:page-4" and uris[21] == "%0Ahttp://x%0D%0A"
    raw = b"".join(bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect())
    kinds = Counter(h["WARC-Type"] for h, _ in warc.parse_warc(raw))
    assert kinds["revisit"] == 5 and kinds["response"] == 11 and kinds["warcinfo"] >= 1
    assert len({h["WARC-Record-ID"] for h, _ in warc.parse_warc(raw) if h["WARC-Type"] == "response" and "WARC-X-Source-ID" in h}) == 8
    referred = {h["WARC-Refers-To"] for h, _ in warc.parse_warc(raw) if h["WARC-Type"] == "revisit"}
    assert referred <= {h["WARC-Record-ID"] for h, _ in warc.parse_warc(raw)}


def test_no_pages(spark):
    assert warc.pages_through_warc(_pages(spark, []), scratch_dir(spark, "t")).collect() == []


def test_both_arc_versions_are_parsed(spark):
    body = b"HTTP/1.0 200 OK\r\n\r\nhello\n\nworld"
    one = [({"URL": "http://a/x", "IP-address": "1.2.3.4", "Archive-date": "19960923142103", "Content-type": "text/html"}, body)]
    two = [({"URL": "dns:a", "Archive-date": "1999", "Content-type": "text/dns", "Result-code": "200", "Filename": "page-7"}, b"a IN A")]
    for version, records in ((1, one), (2, two + one)):
        parsed = list(warc.parse_arc(warc.arc_file("f.arc", version, "20000101000000", records)))
        assert [(r.version, r.fields["URL"], r.body) for r in parsed] == [(version, f["URL"], b) for f, b in records]
    rows = [(bytearray(warc.arc_file("f.arc", v, "2000", r)),) for v, r in ((1, one), (2, two), (2, []))]
    got = {r.uri: r for r in warc.convert_arc(spark.createDataFrame(rows, "content binary")).collect()}
    assert got["http://a/x"].payload == b"hello\n\nworld" and got["http://a/x"].warc_date == "1996-09-23T14:21:03Z"
    assert got["dns:a"].source_id == 7 and not got["dns:a"].is_http and got["dns:a"].warc_date == "1999-01-01T00:00:00Z"
    spaced = warc.arc_file("f.arc", 1, "2000", one).replace(b"http://a/x", b"http://a/x y")
    assert next(warc.parse_arc(spaced)).fields["URL"] == "http://a/x y"


@pytest.mark.parametrize("broken", [b"not a header\n", b"filedesc://x 0.0.0.0 2000 text/plain 9999\n1 0 x\n", b"filedesc://x 0.0.0.0 2000 text/plain 6\n3 0 x\n\nz"])
def test_broken_archives_raise(broken):
    with pytest.raises(ValueError):
        list(warc.parse_arc(broken))
    with pytest.raises(ValueError):
        list(warc.parse_warc(b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabc"))
