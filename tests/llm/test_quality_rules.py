"""Quality rules against plain counts, and the compression bands."""

import base64
import random
import re
from collections import Counter

import zstandard

from sondage.llm import quality_rules as Q
from tests.llm.conftest import prose


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {k + j for k in range(len(words) - 2) for j in range(3) if windows[tuple(words[k : k + 3])] > 1}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = sum(x in lines[:k] for k, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), seen, len(inside)


def test_counts_equal_plain_ones(spark):
    rng = random.Random(4)
    texts = [None, "", " ", "a b c a b c", "x\nx\n x\n\n\nx", "é🙂 ## <b>|\x0b\x0c z", "a a a a a", *(prose(rng, rng.randint(1, 200), 12) for _ in range(40))]
    texts += ["\n".join(rng.choice(["one two", "three ", "", "four"]) for _ in range(rng.randint(1, 30))) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in Q.score_rules(docs).collect():
        counts = plain(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counts
        assert r["base_failed"] == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r["base_failed"] and r["kept"])


def test_bands_reject_repeats_and_noise_and_keep_prose(spark):
    rng = random.Random(6)
    syllables = ["an", "er", "tion", "the", "ou", "re", "st", "le", "in", "ka", "mo", "dri"]
    good = [" ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n)) for n in (60, 300, 5000)]
    noise = " ".join("".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(3)) for _ in range(400))
    repeats = " ".join("".join(rng.choice(syllables) for _ in range(2)) + f" x{k} filler phrase stays same all along" for k in range(3)) * 40
    docs = spark.createDataFrame(list(enumerate([*good, noise, repeats])), "doc_id bigint, text string")
    kept = {r["doc_id"]: r["in_band"] for r in Q.score_rules(docs).collect()}
    assert [kept[k] for k in range(3)] == [True] * 3
    assert not kept[4]


def test_bands_reject_noise_at_every_size():
    rng = random.Random(7)
    pack, bands = zstandard.ZstdCompressor(level=3), Q.Bands()

    def noise(n):
        yield " ".join(base64.b64encode(rng.randbytes(rng.randint(3, 9))).decode() for _ in range(n // 4)).encode()[:n]
        yield base64.b64encode(rng.randbytes(n))[:n]
        yield " ".join("".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(3)) for _ in range(n // 9)).encode()[:n]
        yield "".join(chr(rng.randrange(32, 127)) for _ in range(n)).encode()

    for size in (256, 400, 600, 800, 1024, 1500, 2048, 3000, 6000, 20_000, 100_000):
        for k, text in enumerate(noise(size)):
            assert len(text) > 0.9 * size
            assert not Q.band_verdict(text, pack, bands)[2], (size, k)


def test_noise_of_the_list_above_is_not_kept(spark):
    rng = random.Random(6)
    noise = " ".join("".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(3)) for _ in range(400))
    found = Q.score_rules(spark.createDataFrame([(3, noise)], "doc_id bigint, text string")).first()
    assert not found["base_failed"] and not found["in_band"] and not found["kept"]


def test_the_end_of_a_text_is_judged_too():
    rng = random.Random(8)
    syllables = ["an", "er", "tion", "the", "ou", "re", "st", "le", "in", "ka", "mo", "dri"]
    prose_of = lambda n: " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n)).encode()[:n]
    pack, bands = zstandard.ZstdCompressor(level=3), Q.Bands()
    tail = b"the same words over and over "
    assert Q.band_verdict(prose_of(3900), pack, bands)[1:] == (0.0, True)
    ratio, outside, in_band = Q.band_verdict((prose_of(2048) + tail * 70)[:3900], pack, bands)
    assert outside == 1852 / 3900 and not in_band
    # Each chunk counts with its bytes: 100 left over are no third of the text.
    assert Q.band_verdict(prose_of(4096) + tail * 3, pack, bands)[2]
    # A short text is one chunk.
    assert Q.band_verdict((tail * 60)[:1500], pack, bands)[1] == 1.0


def test_odd_documents(odd_docs, no_docs):
    found = Q.score_rules(odd_docs)
    assert found.count() == odd_docs.count()
    assert found.where("doc_id in (2, 3, 4) and (not base_failed or kept)").count() == 0
    assert Q.score_rules(no_docs).count() == 0
    good = Q.keep_good(odd_docs)
    assert good.columns == odd_docs.columns
    assert {r["doc_id"] for r in good.collect()} == {1, None, 5, 8}
    assert {r["kept"] for r in good.collect()} == {"clash"}
