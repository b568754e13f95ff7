"""Token files, packing, archives and URL rules: round trips and plain versions."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import PROSE, clashing, documents, rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hitledger.llm import packing, token_files, url_filter, warc
from hitledger.llm.common import shared_folder
from hitledger.llm.tokens import Encoder
from hitledger.llm.url_filter import HostRule

TOKENIZERS = [("byte_bpe_50k.json", "spaces"), ("word_bpe_49k.json", "words")]
ODD = list("abXYZ09 \n\t\r\u3000\u00a0\x1c\x85.,'\u2019\u00e9\u0301\u03a3\u00df\u00f1\u4e2d\U0001f389\u0130\u00c0\u00d7") + [
    "'s", " the", "\n\n", "  ", ", ", "Word", "word,", "<|endoftext|>",
]


@pytest.mark.parametrize("name, borders", TOKENIZERS)
def test_pieces_encode_as_the_whole(name, borders):
    path = public_tokenizers.path(name)
    plain, own = Tokenizer.from_file(path), Encoder(path, borders)
    rng = random.Random(3)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(40))) for _ in range(3_000)]
    for text in [*texts, *PROSE]:
        ids = np.frombuffer(own.encode(text.encode()), own.dtype).tolist()
        assert ids == plain.encode(text, add_special_tokens=False).ids, text


def expected_ids(docs, name):
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    return [
        (r.doc_id, np.array([*plain.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4"))
        for r in docs.collect()
    ]


def test_token_files_round_trip(spark):
    docs = documents(spark)
    path = shared_folder(spark, "tokens")
    name, borders = TOKENIZERS[0]
    token_files.write_token_files(clashing(docs), path, public_tokenizers.path(name), borders)
    read = token_files.read_token_files(spark, path).orderBy("start").collect()
    ids = [-(10**9) if r.doc_id is None else r.doc_id for r in read]
    assert ids == sorted(ids)
    at = 0
    for r in read:
        assert r.start == at
        at += r.n_tokens
    got = sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in read), key=repr)
    want = [(i, len(x), zlib.crc32(x.tobytes())) for i, x in expected_ids(docs, name)]
    assert got == sorted(want, key=repr)
    part = spark.read.parquet(f"{path}/index").orderBy("number").first()
    assert token_files.document_tokens(path, part.part, part.width, 0)[-1] == 0


def check_sequences(found, capacity):
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_packing_of_odd_documents(spark):
    docs = documents(spark)
    name, borders = TOKENIZERS[1]
    pieces = packing.pieces(clashing(docs), public_tokenizers.path(name), borders)
    found = packing.packed(pieces).collect()
    want = []
    for i, x in expected_ids(docs, name):
        for k, at in enumerate(range(0, len(x), 2048)):
            own = x[at : at + 2048]
            want.append((i, k, at, len(own), zlib.crc32(own.tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    total = sum(r.length for r in found)
    assert check_sequences(found, 2048) == -(-total // 2048)


@pytest.mark.parametrize("sizes", [(1, 2049), (600, 1100), (1030, 1040), (2048, 2049), (1, 40)])
def test_packing_meets_the_bound_over_many_partitions(spark, sizes):
    rng = random.Random(sizes[0])
    lengths = [rng.randrange(*sizes) for _ in range(3_000)]
    rows_ = [(i, 0, 0, n, 0) for i, n in enumerate(lengths)]
    pieces = spark.createDataFrame(rows_, "doc_id long, piece int, start long, length long, ids_crc32 long")
    found = packing.packed(pieces, partition_pieces=400).collect()
    assert sorted(r.doc_id for r in found) == list(range(3_000))
    n = check_sequences(found, 2048)
    bound = packing.lower_bound(np.array(lengths), 2048)
    alone = len(packing.best_fit_decreasing(np.array(lengths), 2048)[1])
    assert bound <= n <= max(alone * 1.02, alone + 2)


FIVE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def check_certificates(found, capacity):
    """Bins and bounds that the result reports, against what its rows say."""
    n, bound = packing.overall_certificate(found, capacity)
    lengths = np.array([r.length for r in found.collect()], np.int64)
    assert n == len({r.sequence_id for r in found.collect()})
    assert bound == packing.lower_bound(lengths, capacity) <= n
    partitions = packing.certificates(found).collect()
    assert sum(r.kept_bins for r in partitions) == n
    for r in partitions:
        assert 0 < r.kept_bins <= r.bins and r.bound <= r.bins
        assert r.certified == (r.bins == r.bound)
    return partitions


def test_packing_certifies_a_lone_partition(spark):
    rng = random.Random(3)
    data = [(i, 0, 0, rng.randrange(1, 500), 0) for i in range(2_000)]
    found = packing.packed(spark.createDataFrame(data, FIVE))
    (only,) = check_certificates(found, 2048)
    lengths = np.array([n for _, _, _, n, _ in data])
    assert only.bound == packing.lower_bound(lengths, 2048)
    assert only.bins == only.kept_bins == len(packing.best_fit_decreasing(lengths, 2048)[1])


@pytest.mark.parametrize("sizes", [(1, 40), (600, 1100), (700, 800), (1030, 1040), (2048, 2049)])
def test_packing_certifies_every_round(spark, sizes):
    rng = random.Random(sizes[1])
    data = [(i, 0, 0, rng.randrange(*sizes), 0) for i in range(3_000)]
    found = packing.packed(spark.createDataFrame(data, FIVE), partition_pieces=300)
    partitions = check_certificates(found, 2048)
    assert len(partitions) >= 10
    assert sorted(r.doc_id for r in found.collect()) == list(range(3_000))
    # Never worse than the partitions packed for themselves.
    first = [r for r in partitions if r.partition >> packing._PARTITION_BITS == 0]
    assert check_sequences(found.collect(), 2048) <= sum(r.bins for r in first)


def test_packing_of_nothing(spark):
    found = packing.packed(spark.createDataFrame([], FIVE))
    assert packing.certificates(found).count() == 0
    assert packing.overall_certificate(found) == (0, 0)


def test_lower_bound_holds():
    rng = np.random.default_rng(0)
    for _ in range(200):
        lengths = rng.integers(1, rng.integers(2, 12), rng.integers(1, 9))
        bins, left = packing.best_fit_decreasing(lengths, 11)
        assert (np.bincount(bins, lengths) == 11 - left).all()
        assert packing.lower_bound(lengths, 11) <= len(left)
    assert packing.lower_bound(np.array([6, 6, 6]), 11) == 3


def test_archives_round_trip(spark):
    big, other = "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" + "x" * 1200 + "\r\n", "é" * 600
    pages = [
        (1, "http://a.example/x?y=1#z", big),
        (2, "http://b.example", big),
        (3, None, big),
        (4, "http://c.example/ a\r\nb", other),
        (5, "http://c.example", other),
        (5, "http://c.example", other),
        (6, "http://d.example", "short"),
        (7, "http://e.example", "short"),
        (8, "", None),
        (9, "http://f.example", ""),
        (10, "http://f.example", "ends\r\n"),
        (None, "http://g.example", "no id"),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    path = shared_folder(spark, "warc")
    warc.write_archives(clashing_pages(frame), path)
    records = warc.read_records(spark, path, keep_payload=True)
    assert records.count() == 3 * len(pages)
    assert records.where("payload_digest <> declared_digest").isEmpty()
    found = {}
    for r in warc.captures(records).collect():
        page = (r.metadata.fields or "").removeprefix("page-id: ")
        found[page] = r
    assert len(found) == 11 and found["5"].copies == 2
    kinds = {k: v.response.record_type for k, v in found.items()}
    assert {k for k, v in kinds.items() if v == "revisit"} == {"1", "2", "4"}
    assert found["1"].response.refers_to == found["3"].response.record_id
    assert found["4"].response.refers_to == found["5"].response.record_id
    assert bytes(found["3"].response.payload).decode() == big
    assert found["4"].response.target_uri == "http://c.example/%20a%0D%0Ab"
    assert bytes(found["10"].response.payload) == b"ends\r\n" and found["8"].response.payload_bytes == 0
    assert found["1"].request.target_uri == "http://a.example/x?y=1#z"


def clashing_pages(df):
    for name in ("digest", "n_bytes", "original", "value"):
        df = df.withColumn(name, F.lit(7))
    return df


def test_broken_and_orphaned_records(spark, tmp_path):
    import gzip

    head = "WARC/1.1\r\nWARC-Type: request\r\nWARC-Record-ID: <a>\r\nWARC-Concurrent-To: <b>\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    with gzip.open(tmp_path / "one.warc.gz", "wb") as out:
        out.write(head.encode())
    (orphan,) = warc.captures(warc.read_records(spark, str(tmp_path))).collect()
    assert orphan.response is None and orphan.request.record_id == "<a>" and orphan.copies == 0
    with gzip.open(tmp_path / "one.warc.gz", "wb") as out:
        out.write(head.encode()[:-6])
    with pytest.raises(Exception, match="cut short"):
        warc.read_records(spark, str(tmp_path)).collect()


RULES = [
    HostRule("org", "/", "allow"),
    HostRule("example.org", "/es/", "block"),
    HostRule("com", "/de/", "block"),
]


def test_url_rules(spark):
    urls = {
        "http://EXAMPLE.org/es/1": ("example.org", "/es/1", "example.org/es/", "block"),
        "http://x.example.org/es": ("x.example.org", "/es", "org/", "allow"),
        "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "a://b.com/de/?x://y": ("b.com", "/de/", "com/de/", "block"),
        "http://b.com?q=/de/": ("b.com", "", None, "allow"),
        "http://com/de/#f": ("com", "/de/", "com/de/", "block"),
        "//b.com/de/": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "x://": ("", "", None, "allow"),
        "http://\u00c4.org\n/A b?": ("\u00c4.org\n", "/A b", None, "allow"),
        None: ("", "", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)] * 2, "page_id long, url string, rule int")
    none = spark.createDataFrame([], "tokens array<string>, confidence double, lift double, support double")
    found = url_filter.filter_urls(pages, none, RULES).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in found[::2]] == list(urls.values())
    assert found[::2] == found[1::2]
    assert url_filter.filter_urls(pages.limit(0), none, RULES).count() == 0


def test_mined_rules(spark):
    """Pills on /buy/ are bad; every pill host has good pages too."""
    rows_ = []
    for i in range(400):
        bad = i % 4 == 0
        path = "buy" if bad else "info"
        rows_.append((f"http://h{i % 7}.pills.example/{path}/{i}?ref=x", bad))
        rows_.append((f"http://h{i % 7}.news.example/buy/{i}", False))
    rows_ += [(None, True), ("http://x.example/", None)]
    labelled = spark.createDataFrame(rows_, "url string, blocked boolean")
    mined = url_filter.mine_rules(labelled)
    assert {tuple(r.tokens) for r in mined.collect()} >= {("h:pills", "p:buy")}
    assert all(r.confidence >= 0.7 for r in mined.collect())
    pages = spark.createDataFrame(
        [("http://new.pills.example/buy/9",), ("http://new.pills.example/info/9",), ("http://h1.news.example/buy/1",)],
        "url string",
    )
    assert [r.verdict for r in url_filter.filter_urls(pages, mined, []).orderBy("url").collect()] == [
        "allow", "block", "allow",
    ]
    assert url_filter.mine_rules(labelled.limit(0)).count() == 0


def test_rows_of_helpers_are_sorted(spark):
    assert rows(spark.range(3)) == [(0,), (1,), (2,)]
