"""SentencePiece paths and token counts against the libraries and plain recurrences."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece as library
from tokenizers import Tokenizer

import helpers as H
from plumbline.llm import sentencepiece, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BPE = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", "a", " a", "a  b", "  ", "\n\n", "é☃x", "日本語テキスト", "x" * 3000, "🙂🙂 ok",
    "The quick   brown\tfox\r\njumps", "of the thing. Of\nthe", "\u0000 nul", "words " * 5000,
    "<s> control </s> <unk> <0x41>", "ﬁ ligature", "a" + " " * 40 + "b",
]


def encode(texts):
    return sentencepiece.encoder(MODEL).encode(pa.array(texts, pa.large_string())).to_pylist()


def test_paths_have_the_best_score():
    coder = sentencepiece.encoder(MODEL)
    score = {
        t.decode(): float(s)
        for t, s, k in zip(coder.pieces.text, coder.score, coder.pieces.kind, strict=True)
        if k in (sentencepiece.NORMAL, sentencepiece.USER_DEFINED)
    }
    rng = random.Random(5)
    texts = [t for t in ODD if len(t) < 200]
    texts += ["".join(rng.choices("theraindo  ,.é日\n", k=rng.randint(1, 60))) for _ in range(60)]
    byte = set(coder.byte_ids.tolist())
    for text, ids in zip(texts, encode(texts), strict=True):
        found, run = 0.0, []
        for i in [*ids, -1]:
            if i in byte:
                run.append(coder.decoded[i])
                if len(b"".join(run).decode(errors="ignore")) == 1:
                    found, run = found + coder.unknown_score, []
            elif i >= 0:
                found += coder.score[i]
        longest = max(map(len, score))
        whole = " " + text if text else ""
        assert found == H.best_score(whole, score, coder.unknown_score, longest), text


def test_paths_as_the_library_lists_them():
    """The library's lattice on the same pieces, its vocabulary marked as Unigram."""
    with open(MODEL, "rb") as file:
        unigram = library.SentencePieceProcessor(model_proto=file.read() + bytes([0x12, 2, 0x18, 1]))
    texts = ["Er the.", "Ingon the thing", "of that and this for", "thhaheed, andinly was", "a the. the"]
    for text, ids in zip(texts, encode(texts), strict=True):
        assert ids == unigram.nbest_encode_as_ids(text, 2)[0]


def test_round_trip():
    coder = sentencepiece.encoder(MODEL)
    assert [coder.decode(ids) for ids in encode(ODD)] == ODD
    assert [coder.decode(ids) for ids in encode(["a▁b"])] == ["a b"]
    assert coder.decode([int(coder.byte_ids[0xC3])]) == "�"
    with open(MODEL, "rb") as file:
        plain = library.SentencePieceProcessor(model_proto=file.read())
    ids = plain.encode("Hello  world\nthe é☃")
    assert coder.decode(ids) == plain.decode(ids)


def test_batches_do_not_matter():
    together = encode(ODD)
    assert together == [encode([t])[0] for t in ODD]


def test_double_array_holds_its_keys():
    rng = random.Random(1)
    keys = {bytes(rng.choices(range(256), k=rng.randint(1, 6))) for _ in range(2000)}
    trie = sentencepiece.DoubleArray((k, i) for i, k in enumerate(sorted(keys)))
    for i, key in enumerate(sorted(keys)):
        node = np.zeros(1, np.int32)
        for c in key:
            node = trie.walk(node, np.array([c], np.int32))
        assert trie.value[node[0]] == i
    assert trie.walk(np.zeros(1, np.int32), np.array([0], np.int32))[0] == -1 or any(k[0] == 0 for k in keys)


def test_encode_texts(spark):
    rows = [(1, "some text", "x"), (2, None, "x"), (3, "", "x"), (3, "", "x"), (None, "t\nu", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = sentencepiece.encode_texts(docs, MODEL).collect()
    assert sorted((r["row"]["text"] or "", r["decoded"]) for r in found) == sorted((t or "", t or "") for _, t, _ in rows)
    assert all(len(r["ids"]) == r["n_tokens"] and r["row"]["ids"] == "x" for r in found)
    assert sentencepiece.encode_texts(docs.limit(0), MODEL).collect() == []


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(BPE)


def hard_texts():
    rng = random.Random(3)
    parts = ["word ", "  ", "\n", "it's ", "x", "<|endoftext|>", "日本", "é", "1234 ", "!?", "\t", " ", "a" * 300]
    return ["".join(rng.choices(parts, k=rng.randint(1, 400))) for _ in range(40)] + ODD


def test_encoder_is_the_library(tokenizer):
    for text in hard_texts():
        wanted = tokenizer.encode(text, add_special_tokens=False).ids
        assert token_counts.encode(token_counts.encoder(BPE), text) == wanted


@pytest.mark.parametrize(("chunk", "overlap"), [(50, 4), (64, 16), (200, 1), (1000, 64)])
def test_spliced_is_whole(tokenizer, chunk, overlap):
    coder = token_counts.encoder(BPE)
    for text in hard_texts():
        wanted = tokenizer.encode(text, add_special_tokens=False).ids
        assert token_counts.encode_spliced(coder, text, chunk, overlap) == wanted


def test_spliced_without_any_blank(tokenizer):
    coder = token_counts.encoder(BPE)
    for text in ("日本語" * 3000, "ab" * 9000, "é" * 5000 + " end", " " * 20000, "\n" * 9000):
        assert token_counts.encode_spliced(coder, text, 512, 16) == tokenizer.encode(text, add_special_tokens=False).ids


def test_count_tokens(spark, tokenizer):
    rows = [(k, t, 0) for k, t in enumerate([*ODD, None, "again", "again", "w " * 40000])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    found = token_counts.count_tokens(docs, BPE, ["doc_id"]).collect()
    texts = {k: t or "" for k, t, _ in rows}
    for r in found:
        n = len(tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 1024)
    assert len(found) == len(rows)
    assert token_counts.count_tokens(docs.limit(0), BPE, ["doc_id"]).collect() == []


def test_kept_columns_of_any_name(spark, tokenizer):
    docs = spark.createDataFrame([(1, "two words", 7, "x", None)], "doc_id long, body string, n_tokens int, text string, over_limit string")
    found = token_counts.count_tokens(docs, BPE, ["doc_id", "n_tokens", "text", "over_limit", "body"], text="body")
    assert found.columns == ["doc_id", "n_tokens_", "text", "over_limit_", "body", "n_bytes", "n_tokens", "over_limit"]
    n = len(tokenizer.encode("two words", add_special_tokens=False).ids)
    assert tuple(found.select("*").first()) == (1, 7, "x", None, "two words", 9, n, False)
    assert found.select("n_tokens").first()[0] == n
