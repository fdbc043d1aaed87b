import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tarmac.llm import bpe

from .helpers import documents

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_ranks(PATH), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(bpe.read_ranks(PATH))}, special_tokens={})


def texts():
    rng = random.Random(4)
    bits = ["a", " the", "ing", "\n", "  ", "\t", "é", "ß", "日本語", "한국", "🙂", "'s", "'", "12", "½", ".", "…", "\x1c", "\x85", "\xa0", " ", "​", "<|endoftext|>", "\U000323b0", "\U00010940", "՘", "\U00012550", "x́", "�", "\U0010ffff"]
    out = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 80))) for _ in range(400)]
    out += ["".join(chr(rng.choice([rng.randrange(0x20, 0x250), rng.randrange(0x250, 0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(50)) for _ in range(300)]
    return [*out, "", " ", "\n \n", "a" * 20_000, "ab" * 9000 + " " * 5000, "z" * 700 + "é" * 700, "word and word. " * 20_000]


def test_the_hash_is_minimal_and_perfect():
    for n in (0, 1, 2, 3, 7, 1000, 5000):
        keys = [f"key {i}".encode() for i in range(n)]
        made = bpe.PerfectHash(keys)
        assert sorted(made.index) == list(range(n))
        assert [made.lookup(k) for k in keys] == list(range(n))
    with pytest.raises(ValueError):
        bpe.PerfectHash([b"a", b"b", b"a"])


def test_every_token_is_found_whole(encoder):
    assert [encoder.rank(t) for t in encoder.tokens] == list(range(len(encoder.tokens)))
    assert encoder.rank(b"") == -1 and encoder.rank(b"no token of this vocabulary") == -1


def test_ids_equal_those_of_the_library(encoder, library):
    for text in texts():
        ids = encoder.encode(text).tolist()
        assert ids == library.encode_ordinary(text), text[:80]
        assert encoder.decode(ids) == text.encode()


def test_every_code_point_is_split_as_by_the_library(encoder, library):
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    for i in range(0, len(points), 4096):
        text = "".join(f"a{chr(c)}1{chr(c)} " for c in points[i : i + 4096])
        assert encoder.encode(text).tolist() == library.encode_ordinary(text)


def test_memory_is_bounded(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    monkeypatch.setattr(bpe, "CHUNK", 7)
    text = " ".join(f"w{i}x" for i in range(3000))
    assert encoder.encode(text).tolist() == library.encode_ordinary(text)
    assert len(encoder) <= 50


def test_rank_files(tmp_path):
    lines = open(PATH, "rb").read().splitlines()
    (tmp_path / "gap").write_bytes(b"\n".join([*lines[:300], *lines[301:400]]))
    with pytest.raises(ValueError, match="gap"):
        bpe.read_ranks(str(tmp_path / "gap"))
    (tmp_path / "few").write_bytes(b"\n".join(lines[:10]))
    with pytest.raises(ValueError, match="single bytes"):
        bpe.read_ranks(str(tmp_path / "few"))


def test_frames(spark, encoder, library):
    rows = [(i, t) for i, t in enumerate(texts())] + [(900, None), (901, ""), (None, "no id"), (3, "twice"), (3, "twice")]
    found = bpe.decode(bpe.encode(documents(spark, rows), encoder), encoder).withColumn("sha", bpe.digest(bpe.F.col("ids")))
    got = sorted((str(r.doc_id), list(r.ids), bytes(r.decoded), r.sha) for r in found.collect())
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((str(i), ids, (t or "").encode(), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.decode(bpe.encode(documents(spark, []), encoder), encoder).count() == 0
    none = bpe.decode(spark.createDataFrame([(None,)], "ids array<int>"), encoder).first()
    assert none.decoded is None


def test_texts_of_the_basic_plane_are_split_by_spelled_out_classes(encoder):
    import re

    assert all(isinstance(s, re.Pattern) for s in (encoder.ascii, encoder.basic))
    for text in texts():
        split = encoder.ascii if text.isascii() else encoder.basic
        if max(text, default="") <= "￿":
            translated = text.translate(encoder.classes)
            assert list(encoder.pieces(text)) == split.findall(text) == [text[m.start() : m.end()] for m in encoder.split.finditer(translated)]


def test_patterns_that_may_be_read_differently_are_left_to_the_other_splitter(library):
    for pattern in (r"\p{Lu}+|.", r"\P{L}+", r"\w+|\W", r"(?i:a)+", r"[\S]", r"^a|$", r"[[a-c]x]"):
        assert bpe.spelled_out(pattern, 0x7F) is None
    odd = bpe.Encoder(bpe.read_ranks(PATH), r"\p{Lu}+|\P{Lu}+")
    assert odd.plain == [None, None]
    assert list(odd.pieces("abCD éÉ\U0001f642")) == ["ab", "CD", " é", "É", "\U0001f642"]
