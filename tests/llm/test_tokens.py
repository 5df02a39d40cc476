import public_tokenizers
from tokenizers import Tokenizer

from vellum.llm import tokens
from vellum.llm.tokens import Counter, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", "a", "Hello, world's it's I'LL", "<|endoftext|> x <|startoftext|>", "a<|endoftext|>b", "é café ́ x", "Σίσυφος ΟΔΟΣ", "İstanbul ǅ ﬁ", "日本語 テスト 123 ½", "a b c\x0bd\x0ce\x1cf\x85g h", "x" * 3000, " \n\t ", "a!!!b***c 🙂🙂", "don't 'S ''re", "가 ᆨ", "tab\tnew\nline\r\nend"]


def test_counter_matches_library(monkeypatch):
    t = Tokenizer.from_file(PATH)
    monkeypatch.setattr(tokens, "BATCH_BYTES", 40)
    monkeypatch.setattr(tokens, "CACHE", 60)
    texts = ODD + [" ".join(ODD)] + ["the quick brown fox " * 40]
    assert Counter(PATH).count([x.encode() for x in texts]) == [len(t.encode(x, add_special_tokens=False).ids) for x in texts]


def test_query_on_documents(spark):
    t = Tokenizer.from_file(PATH)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in token_counts(docs, PATH).collect()}
    for r in docs.collect():
        n = len(t.encode(r.text, add_special_tokens=False).ids)
        assert (got[r.doc_id].n_tokens, got[r.doc_id].n_bytes, got[r.doc_id].over_limit) == (n, len(r.text.encode()), n > 2048)


def test_odd_rows(spark):
    rows = spark.createDataFrame([(1, None, 9), (2, "", 9), (2, "a b", 9), (None, "a", 9)], "doc_id long, text string, n_tokens int")
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(rows, PATH).collect()) == [(0, 1, 1, False), (1, 0, 0, False), (2, 0, 0, False), (2, 3, 2, False)]
    assert token_counts(rows.limit(0), PATH).collect() == []


def test_a_tokenizer_whose_tokens_hold_white_space_encodes_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    counter = Counter(path)
    assert not counter.parted and Counter(PATH).parted
    assert counter.count([x.encode() for x in ODD]) == [len(t.encode(x, add_special_tokens=False).ids) for x in ODD]
