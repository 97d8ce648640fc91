import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

from siltbed.llm import isomedia


def test_probe_of_own_containers():
    for frames in (1, 15, 16, 17, 32, 100):
        payload = random.Random(frames).randbytes(frames * isomedia.FRAME)
        media = isomedia.write_container(payload)
        track = isomedia.probe(media)
        assert (track.codec, track.timescale, track.duration, len(track.sizes)) == ("uncv", 25, frames, frames)
        assert track.payload(media) == payload
        for k, (a, b) in zip(range(0, frames, 16), track.ranges()):
            assert media[a:b] == payload[k * 576 : (k + 1) * 576]
        assert len(track.ranges()) == -(-frames // 16)


def test_probe_of_other_layouts():
    # samples of different sizes in two chunks apart, 64-bit offsets, version 1 header, no sync table
    sizes = [3, 5, 2]
    tables = [
        isomedia.full(b"stsd", struct.pack(">I", 1), isomedia.box(b"avc1", bytes(78))),
        isomedia.table(b"stts", np.array([(3, 10)])),
        isomedia.table(b"stsc", np.array([(1, 2, 1), (2, 1, 1)])),
        isomedia.full(b"stsz", struct.pack(">II3I", 0, 3, *sizes)),
        isomedia.table(b"co64", np.array([24, 40]), ">u8"),
    ]
    mdhd = isomedia.full(b"mdhd", struct.pack(">QQIQHH", 0, 0, 90000, 30, 0, 0), version=1)
    body = isomedia.box(b"mdat", bytes(16) + b"abcdefgh" + bytes(8) + b"ij")
    media = body + isomedia.box(b"moov", isomedia.box(b"trak", isomedia.box(b"mdia", mdhd, isomedia.box(b"minf", isomedia.box(b"stbl", *tables)))))
    track = isomedia.probe(media)
    assert (track.codec, track.timescale, track.duration) == ("avc1", 90000, 30)
    assert track.payload(media) == b"abcdefghij" and track.ranges().tolist() == [[24, 27], [27, 32], [40, 42]]
    with pytest.raises(ValueError):
        isomedia.probe(b"\x00\x00\x00\xffmoov" + bytes(20))
    with pytest.raises(ValueError):
        isomedia.probe(isomedia.box(b"ftyp", b"isom"))


def track(codec, number, sizes, offset, keys=None, fragmented=False):
    n = len(sizes)
    tables = [
        isomedia.full(b"stsd", struct.pack(">I", 1), isomedia.box(codec, bytes(78))),
        isomedia.table(b"stts", np.array([(n, 10)] if n else np.empty((0, 2)))),
        isomedia.table(b"stsc", np.array([(1, n, 1)] if n else np.empty((0, 3)))),
        isomedia.full(b"stsz", struct.pack(f">II{n}I", 0, n, *sizes)),
        isomedia.table(b"stco", np.array([offset] if n else [])),
    ]
    tables += [isomedia.table(b"stss", np.array(keys))] if keys else []
    mdhd = isomedia.full(b"mdhd", struct.pack(">IIIIHH", 0, 0, 1000, 10 * n, 0, 0))
    tkhd = isomedia.full(b"tkhd", struct.pack(">IIIII", 0, 0, number, 0, 0), bytes(60))
    return isomedia.box(b"trak", tkhd, isomedia.box(b"mdia", mdhd, isomedia.box(b"minf", isomedia.box(b"stbl", *tables))))


def test_tracks_keep_their_own_tables():
    media = isomedia.box(b"mdat", b"aabbccVIDEO") + isomedia.box(b"moov", track(b"mp4a", 1, [2, 2, 2], 8), track(b"avc1", 2, [1, 4], 14, [1]))
    audio, video = isomedia.probe_tracks(media)
    assert (audio.codec, audio.ranges().tolist()) == ("mp4a", [[8, 10], [10, 12], [12, 14]])
    assert (video.codec, video.ranges().tolist(), video.payload(media)) == ("avc1", [[14, 15]], b"VIDEO")


def test_fragmented_files():
    trex = isomedia.box(b"mvex", *(isomedia.full(b"trex", struct.pack(">IIIII", k, 1, 7, 3, 0x10000)) for k in (1, 2)))
    head = isomedia.box(b"moov", track(b"avc1", 1, [], 0), track(b"mp4a", 2, [], 0), trex)

    def fragment(at, data):
        def moof(offset):
            one = isomedia.full(b"trun", struct.pack(">IiIIIII", 2, offset, 0, 5, 0x10000, 2, 0x10000), flags=0x1 | 0x4 | 0x200 | 0x400)
            more = isomedia.full(b"trun", struct.pack(">I", 1))  # follows the run before, sizes by default
            own = isomedia.full(b"trun", struct.pack(">Ii", 2, offset + 10), flags=1)
            return isomedia.box(b"moof", isomedia.box(b"traf", isomedia.full(b"tfhd", struct.pack(">I", 1), flags=0x20000), one, more), isomedia.box(b"traf", isomedia.full(b"tfhd", struct.pack(">III", 2, 4, 0), flags=0x20000 | 0x8 | 0x20), own))

        return moof(len(moof(0)) + 8) + isomedia.box(b"mdat", data)

    media = head
    for k in range(2):
        media += fragment(len(media), b"KKKKKppDDD" + b"aaabbb")
    video, audio = isomedia.probe_tracks(media)
    assert video.payload(media) == b"KKKKKppDDD" * 2 and audio.payload(media) == b"aaabbb" * 2
    assert [media[a:b] for a, b in video.ranges()] == [b"KKKKK"] * 2 and len(audio.ranges()) == 4
    assert (video.duration, audio.duration) == (6 * 7, 4 * 4)


def test_compact_sizes():
    for width, packed in ((4, bytes([0x12, 0x30])), (8, bytes([1, 2, 3])), (16, bytes([0, 1, 0, 2, 0, 3]))):
        data = struct.pack(">IBBBBI", 0, 0, 0, 0, width, 3) + packed
        assert isomedia.sample_sizes(data, {b"stz2": 0}).tolist() == [1, 2, 3]


def test_features_match_brute_force(spark):
    texts = ["", None, "a", "é" * 288, "x" * 576, "x" * 577, "long ünï " * 20_000, "a"]
    df = spark.createDataFrame([(i, t, "m", 1) for i, t in enumerate(texts)] + [(None, "z", None, 0)], "doc_id long, text string, media string, id int")
    got = {r.doc_id: r for r in isomedia.features(df).collect()}
    assert len(got) == len(texts) + 1
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 or (0 if raw else 576))
        media = isomedia.write_container(payload)
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert (r.media_bytes, r.media_sha256) == (len(media), hashlib.sha256(media).hexdigest())
    assert got[2][1:] == got[7][1:] and got[2].feature.startswith("codec=uncv;duration=1/25;frames=1;keyframes=")
    assert isomedia.features(df.limit(0)).count() == 0


def test_whatever_is_no_container_is_a_value_error():
    import random
    import struct

    r = random.Random(5)
    good = isomedia.write_container(bytes(range(256)) * 9)
    for n in range(4000):
        data = bytearray(good)
        for _ in range(r.randint(1, 4)):
            at = r.randrange(len(data) - 8)
            if n % 2:
                data[at] = r.randrange(256)
            else:
                data[at : at + 4] = struct.pack(">I", r.choice([0, 1, 0xFFFFFFFF, 0x7FFFFFFF, r.getrandbits(32)]))
        if n % 5 == 0:
            del data[r.randrange(len(data)) :]
        try:
            track = isomedia.probe(bytes(data))
            assert len(track.sizes) <= len(good) + len(data)
        except ValueError:
            pass
    deep = b"junk"
    for _ in range(3000):
        deep = isomedia.box(b"moov", deep)
    with pytest.raises(ValueError):
        isomedia.probe(deep)
    for data in (b"", b"\0" * 7, b"\0\0\0\x08free", b"text that is none"):
        with pytest.raises(ValueError):
            isomedia.probe(data)
