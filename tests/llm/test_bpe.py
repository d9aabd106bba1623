"""BPE against the tiktoken library, and exact round trips."""

import random

import public_tokenizers
import tiktoken

from tallyline.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [
    None, "", " ", "\n\n  x", "don't I'LL we've", "a" * 20_000, "日本語 é́ 👩‍👩‍👧 12³ ½ Ⅷ", "\x1c\x1d x\x85\xa0y　z",
    "<|endoftext|>", "\x00￿", "   tail   ", "x" * 3 + " " * 5000, "12345678901234567890",
]


def _library():
    ranks = bpe.read_ranks(PATH)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash():
    ranks = bpe.read_ranks(PATH)
    table = bpe.PerfectHash(list(ranks), list(ranks.values()))
    assert len(table.keys) == len(ranks) and all(table.get(k) == v for k, v in ranks.items())
    assert table.get(b"no such entry at all") == -1
    assert bpe.PerfectHash([], []).get(b"a") == -1 and bpe.PerfectHash([b"a"], [7]).get(b"a") == 7


def test_merges_equal_the_library():
    library, merges = _library(), bpe.Merges(bpe.read_ranks(PATH))
    r = random.Random(1)
    for _ in range(1500):
        word = "".join(r.choice("abehinorst" * 3 + "éßñ日") for _ in range(r.randint(1, 40)))
        if len(pieces := library.encode_ordinary(word)) and word.isalpha():
            assert bpe.merge(word.encode(), merges) == pieces


def test_encode_and_decode(spark):
    library, tokenizer = _library(), bpe.Tokenizer(spark, PATH, public_tokenizers.PATTERN)
    df = spark.createDataFrame(list(enumerate(ODD * 2)), "id int, text string")
    df = df.select("id", "text", tokenizer.encode("text").alias("ids"))
    for row in df.select("*", tokenizer.decode("ids").alias("back")).collect():
        assert row.ids == library.encode_ordinary(row.text or ""), row.text
        assert bytes(row.back).decode() == (row.text or "")
    assert df.where("false").select(tokenizer.decode("ids")).count() == 0


def test_ids_outside_the_vocabulary(spark):
    tokenizer = bpe.Tokenizer(spark, PATH, public_tokenizers.PATTERN)
    df = spark.createDataFrame([(1, [64]), (2, [64, 99_999]), (3, [-1]), (4, None), (5, []), (6, [None])], "i int, ids array<int>")
    got = {r.i: r.b for r in df.select("i", tokenizer.decode("ids").alias("b")).collect()}
    assert got == {1: bytearray(bpe_byte(64)), 2: None, 3: None, 4: None, 5: bytearray(), 6: None}


def bpe_byte(rank):
    return next(k for k, v in bpe.read_ranks(PATH).items() if v == rank)
