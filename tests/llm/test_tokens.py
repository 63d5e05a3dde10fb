import random
import unicodedata

import pytest
from tokenizers import Tokenizer

from dossier.llm.queries import MAX_TOKENS, op1_token_counts, tokenizer_path
from dossier.llm.tokens import PieceCounter, count_tokens
from tests.llm.util import documents, prose

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def counter(tokenizer):
    with open(tokenizer_path(), encoding="utf-8") as file:
        return PieceCounter(file.read(), {}, cache_size=50)


def length(tokenizer, text):
    return len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_every_safe_character_between_letters_digits_and_signs(tokenizer, counter):
    for code in [*range(0, 0x250), 0x2028, 0x3000, 0x0301, 0x1F600, 0x4E2D]:
        for text in (f"ab{chr(code)}cd", f"1{chr(code)}2", f"'{chr(code)}'s!", f"X {chr(code)} {chr(code)}{chr(code)}"):
            assert counter.count(text) == length(tokenizer, text), (code, text)


ODD = [
    "", " ", "\n\t", "it's we'll I'd they've o'clock 's", "!!!'s", "<|endoftext|>", "a<|startoftext|>b <|endoftext|>",
    "<|ENDOFTEXT|> <|endof", "é é ﬁ ½ ²3 ª", "\x1c\x85\xa0x", "中文字符 と カナ", "😀😀a😀", "İstanbul ǅ ſ", "a" * 3000,
]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(tokenizer, counter, text):
    assert counter.count(text) == length(tokenizer, text)


def test_tables_change_no_count(spark, tokenizer):
    rnd = random.Random(1)
    texts = [prose(rnd, 60) for _ in range(20)] + [*ODD, None, prose(rnd, 30_000)]
    docs = documents(spark, *texts).withColumnRenamed("lang", "n_bytes_of")
    for options in ({}, {"table_size": 3, "task_size": 2}):
        rows = count_tokens(docs.repartition(3), tokenizer_path(), **options).collect()
        assert len(rows) == len(texts)
        for row in rows:
            assert row.n_tokens == length(tokenizer, row.text)
            assert row.n_bytes == len((row.text or "").encode())


def test_query_against_the_library(spark, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op1_token_counts(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for row in rows:
        n = length(tokenizer, texts[row.doc_id])
        assert (row.n_tokens, row.over_limit) == (n, n > MAX_TOKENS)


def test_empty_table(spark):
    assert count_tokens(documents(spark), tokenizer_path()).count() == 0


def test_unknown_kinds_of_tokenizer_are_refused(spark):
    with pytest.raises((ValueError, KeyError, TypeError)):
        count_tokens(documents(spark), tokenizer_path("byte_bpe_50k.json"))


REAL = [
    "it’s plain “English” text — with a dash, 100 € and more…", "Привет, мир! Как дела?", "Ελληνικά κείμενα Σίσυφος", "مرحبا بالعالم ١٢٣",
    "中文分词，测试。", "हिन्दी में पाठ", "Ｆｕｌｌ　ｗｉｄｔｈ １２", "e\u0301te\u0301 A\u030a ﬁ İI ẞ ǅ", "🙂👍🏽 ok", "한국어 텍스트", "x² ½ Ⅷ ⅷ ٣",
]


@pytest.mark.parametrize("text", REAL)
def test_texts_of_all_scripts_are_answered_piece_by_piece(tokenizer, counter, text):
    assert counter.pieces(text) is not None
    assert counter.count(text) == length(tokenizer, text)


def test_characters_of_all_of_unicode(tokenizer):
    """Letters, marks, numbers, signs and white space, each among letters, digits and signs of its neighbourhood."""
    with open(tokenizer_path(), encoding="utf-8") as file:
        counter = PieceCounter(file.read(), {})
    rnd, whole = random.Random(2), 0
    codes = [c for c in range(0x110000) if unicodedata.category(chr(c)) not in ("Cs", "Cn", "Co")]
    for block in range(0, len(codes), 40):
        found = codes[block : block + 40]
        text = "".join(rnd.choice(["a", "1", "!", " ", "'s", "Ä", "\u0301", chr(rnd.choice(found))]) + chr(c) for c in found)
        whole += counter.pieces(text) is None
        assert counter.count(text) == length(tokenizer, text), text
    assert whole == 0 and len(codes) > 140_000


def test_characters_too_new_to_be_sure_of(tokenizer, counter):
    for code in (0x088F, 0x1C89, 0x323B0, 0x10D40, 0xFFFF, 0xE000):
        text = f"ab{chr(code)}cd 1{chr(code)}"
        assert counter.count(text) == length(tokenizer, text)
