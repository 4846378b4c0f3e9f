import hashlib
import struct
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from docframe.llm import ogg_media, sharding, url_filter


def test_url_rules_and_terms(spark):
    cases = {
        "https://a.Example.COM/en/71?x": ("a.example.com", "/en/71", "example.com/en/7", "allow"),
        "http://b.com/en/1#t": ("b.com", "/en/1", "com/en/", "block"),
        "http://x.example.net/de/81": ("x.example.net", "/de/81", "example.net/de/8", "block"),
        "http://x.example.net/de/1": ("x.example.net", "/de/1", "net/de/", "allow"),
        "http://q.org/es/": ("q.org", "/es/", "org/es/", "block"),
        "http://notorg/es/": ("notorg", "/es/", None, "allow"),
        "http://best-porn.example/x": ("best-porn.example", "/x", None, "block"),
        "http://popcorn.example/pornography": ("popcorn.example", "/pornography", None, "allow"),
        "http://casino.example/": ("casino.example", "/", None, "allow"),
        "http://casino.example/casino/casino": ("casino.example", "/casino/casino", None, "allow"),
        "http://casino.example/poker?bet=1": ("casino.example", "/poker", None, "block"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    df = spark.createDataFrame([(u, 1) for u in cases for _ in range(2)], "url string, host int")
    got = url_filter.judge_urls(df.withColumnRenamed("host", "clash"), keep=["url"]).collect()
    assert len(got) == 2 * len(cases)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == cases[r.url], r
    assert url_filter.judge_urls(df.limit(0)).count() == 0


def test_sharding_is_even_gapless_and_grows_into_the_new_shard_only(spark, tmp_path, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(None, None), (None, ""), (5, None), (5, None), (7, "é" * 9)], "doc_id long, text string")
    rows = sharding.shard_documents(docs.union(odd), 4, str(tmp_path / "map")).collect()
    assert len(rows) == docs.count() + 5
    loads, slots = Counter(), defaultdict(list)
    for r in rows:
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(loads.values()) - min(loads.values()) <= 0.02 * sum(loads.values()) / 4
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        if r.doc_id in texts and r.doc_id not in (5, 7):
            raw = (texts[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id is None} == {(16, 0)}
    old, new = (sharding.load_slot_map(spark, str(tmp_path / "map"), v) for v in (1, 2))
    assert sharding.load_slot_map(spark, str(tmp_path / "map")).first().version == 2
    # the greedy pass by brute force
    slots = Counter()
    for r in rows:
        slots[r.virtual_slot] += r.size
    loads, owner = [0] * 4, {}
    for slot, size in sorted(slots.items(), key=lambda x: (-x[1], x[0])):
        owner[slot] = loads.index(min(loads))
        loads[owner[slot]] += size
    assert {r.virtual_slot: r.shard for r in old.collect()} == owner == {r.virtual_slot: r.shard for r in rows}
    assert {r.virtual_slot: r.shard for r in new.collect()} == {r.virtual_slot: r.rebalanced_shard for r in rows}
    assert sharding.load_slot_map(spark, str(tmp_path / "map"), 1).count() == old.count() == new.count()
    both = old.join(new.select("virtual_slot", F.col("shard").alias("now")), "virtual_slot").collect()
    assert all(r.now in (r.shard, 4) for r in both)
    after = Counter()
    for r in both:
        after[r.now] += r.bytes
    assert after[4] >= 0.5 * sum(after.values()) / 5 and max(after.values()) <= 1.3 * sum(after.values()) / 5
    assert sharding.shard_documents(docs.limit(0), 4, str(tmp_path / "none")).count() == 0


def test_sharding_spreads_a_hot_key(spark, tmp_path):
    hot = [(None, "x" * 500)] * 3000 + [(5, f"{i:0500d}") for i in range(3000)] + [(i, "y" * 500) for i in range(10, 3010)]
    docs = spark.createDataFrame(hot, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("spread", F.lit("clash"))
    rows = sharding.shard_documents(docs, 10, str(tmp_path / "map")).collect()
    loads, slots = Counter(), defaultdict(list)
    for r in rows:
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(rows) == 9000
    assert max(loads.values()) - min(loads.values()) <= 0.02 * sum(loads.values()) / 10
    assert max(Counter(r.virtual_slot for r in rows).values()) < 20


def slow_crc(data: bytes) -> int:
    crc = 0
    for b in data:
        crc ^= b << 24
        for _ in range(8):
            crc = (crc << 1 ^ 0x04C11DB7 if crc & 0x80000000 else crc << 1) & 0xFFFFFFFF
    return crc


#: Fixed bytes: capture pattern, version, flags, granule, serial, number, checksum, lacing and body of one page.
FIRST_PAGE = "4f676753000200000000000000000100feca0000000010746f7f010468656164"


def pages_of(media: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(media):
        n = media[at + 26]
        end = at + 27 + n + sum(media[at + 27 : at + 27 + n])
        out.append(media[at:end])
        at = end
    return out


def foreign_page(flags, granule, serial, number, lacing, body):
    head = b"OggS\0" + bytes([flags]) + struct.pack("<qII", granule, serial, number)
    rest = bytes([len(lacing), *lacing]) + body
    return head + struct.pack("<I", slow_crc(head + b"\0\0\0\0" + rest)) + rest


def test_ogg_of_another_writer():
    """Pages put together by hand: two streams, packets over three pages, a page in which no packet ends, an empty packet."""
    a, b = 0xCAFE0001, 0x10
    data = b"".join([
        foreign_page(2, 0, a, 0, [4], b"head"),
        foreign_page(2, 0, b, 0, [3], b"two"),
        foreign_page(0, -1, a, 1, [255], b"x" * 255),
        foreign_page(4, 7, b, 1, [0, 2], b"ok"),
        foreign_page(1, -1, a, 2, [255, 255], b"y" * 510),
        foreign_page(5, 960, a, 3, [0, 1], b"z"),
    ])
    got = ogg_media.read_ogg(data)
    assert got[a].packets == [b"head", b"x" * 255 + b"y" * 510, b"z"] and got[a].granules == [0, -1, 960] and got[a].pages == 4
    assert got[b].packets == [b"two", b"", b"ok"] and got[b].granules == [0, -1, 7]
    # fixed bytes: the first page of a stream with the packet b"head"
    assert data[: 27 + 5].hex() == FIRST_PAGE


def test_ogg_round_trip_and_damage(spark):
    assert ogg_media.page_crc(b"OggS\0\1any bytes") == slow_crc(b"OggS\0\1any bytes")
    for text in ("", "a", "x" * 63, "y" * 64, "é" * 5000, "z" * 300_001):
        n, payload = ogg_media.payload_of(text)
        assert len(payload) % 64 == 0 and len(payload) >= 64 and payload[:n] == text.encode()
        media = ogg_media.write_ogg(payload)
        samples, streams = ogg_media.read_pcm(media)
        assert samples == payload and len(streams) == 2
        for s in streams.values():
            assert s.granules[1:] == [sum(map(len, s.packets[1 : i + 1])) for i in range(1, len(s.packets))]
        assert ogg_media.media_row(text)[1:4] == (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        for i in range(0, len(media), max(1, len(media) // 50)):
            broken = bytearray(media)
            broken[i] ^= 0x10
            with pytest.raises(ogg_media.OggError):
                ogg_media.read_pcm(bytes(broken))
    media = ogg_media.write_ogg(b"s" * 200_000)
    for cut in range(0, len(media), 1997):
        with pytest.raises(ogg_media.OggError):
            ogg_media.read_pcm(media[:cut])
    pages = pages_of(media)
    assert b"".join(pages) == media and len(pages) > 4
    for k in range(len(pages)):
        with pytest.raises(ogg_media.OggError):
            ogg_media.read_pcm(b"".join(pages[:k] + pages[k + 1 :]))
    for rate, second in ((0, b"cd"), (8000, b"c"), (8000, b"")):  # no rate; uneven channels
        heads = [b"PCM     " + struct.pack("<IIIBB", rate, 1, k, 8, 1) for k in (0, 1)]
        uneven = [list(ogg_media.write_stream(k + 1, [(heads[k], 0), (body, len(body))])) for k, body in enumerate((b"abcd", second))]
        whole = b"".join(uneven[0][:1] + uneven[1][:1] + uneven[0][1:] + uneven[1][1:])
        with pytest.raises(ogg_media.OggError):
            [s.seconds() for s in ogg_media.read_pcm(whole)[1].values()]
        assert spark.createDataFrame([(whole,)], "m binary").select(ogg_media.ogg_features("m").alias("f")).first().f.samples is None
    df = spark.createDataFrame([("abc",), (None,), ("",)], "text string")
    media = df.select(ogg_media.to_ogg("text").alias("m")).union(spark.createDataFrame([(b"bad",), (None,)], "m binary"))
    got = media.select(ogg_media.ogg_features("m").alias("f")).select("f.*").collect()
    assert [r.n_streams for r in got] == [2, 2, 2, None, None] and bytes(got[0].samples) == b"abc" + b"\0" * 61
    assert df.limit(0).select(ogg_media.media_digests(F.col("text"))).count() == 0
