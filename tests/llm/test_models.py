"""Tokens, language identification and the quality classifier."""

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from conftest import DATA
from plain import encoded, encoding
from pyspark.sql import functions as F

from millrace.llm.bpe import bpe_model, decode_ids, encode_texts, read_ranks
from millrace.llm.language import ByteCNN, cut, predict_language, train_language_model
from millrace.llm import quality_model
from millrace.llm.hashing import word_hashes
from millrace.llm.quality_model import DIMS, TwoLayerNet, pooled, score_quality, train_quality_model, word_vectors

TEXTS = [
    "Plain words, it's 3 o'clock; we'll see.",
    "  spaces   and\n\n\tbreaks \r\n end  ",
    "äöü ß çé ñ — “quotes” 中文字符 日本語 한국어 🙂👍🏽",
    "\x00\x01 control \x7f <|endoftext|>",
    "x" * 3000 + " " + "ab" * 2000,
    "1234567890 12 3.14159",
    "",
    None,
    "'S 'T 'RE isn't",
    "▁ Āǿ一 mapped characters themselves",
]


@pytest.fixture(scope="module")
def tokens():
    return read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def test_tokens_equal_the_reference_library(spark, tokens):
    docs = spark.createDataFrame([(i, t, b"x") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids binary")
    out = decode_ids(encode_texts(docs, tokens, public_tokenizers.PATTERN), tokens).orderBy("doc_id").collect()
    wanted = encoded([(i, t, None) for i, t in enumerate(TEXTS)])
    assert [(r.doc_id, r.n_tokens, bytes(r.ids)) for r in out] == [w[:3] for w in wanted]
    assert [bytes(r.decoded).decode() for r in out] == [t or "" for t in TEXTS]


def test_documents_round_trip(spark, tokens):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = decode_ids(encode_texts(docs, tokens, public_tokenizers.PATTERN), tokens)
    joined = out.join(docs, "doc_id").filter(F.col("decoded") == F.col("text").cast("binary"))
    assert joined.count() == docs.count()
    by = encoding()
    ids = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in out.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(by.encode_ordinary(texts[i] or "") == found for i, found in ids.items())


def test_every_token_encodes_to_itself(tokens):
    import sentencepiece

    from millrace.llm.bpe import _mapped

    model = sentencepiece.SentencePieceProcessor(model_proto=bpe_model(tokens))
    assert model.vocab_size() == len(tokens) + 1
    sample = list(range(0, len(tokens), 7))
    assert model.encode([_mapped(tokens[i]) for i in sample]) == [[i] for i in sample]


def test_ranks_must_be_whole(tmp_path):
    (tmp_path / "r").write_text("YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError):
        read_ranks(str(tmp_path / "r"))


def test_empty_tables(spark, staging, tokens):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert decode_ids(encode_texts(docs, tokens, public_tokenizers.PATTERN), tokens).count() == 0
    model = train_language_model(docs, F.lit(True))
    assert predict_language(docs, model).count() == 0
    vectors = word_vectors(docs)
    net = train_quality_model(docs, labels, vectors, F.lit(True))
    assert score_quality(docs, vectors, net).count() == 0 and not vectors.vectors.any()


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    model = train_language_model(docs, ~held_out, per_language=300)
    out = predict_language(docs.withColumn("score", F.lit("x")), model).join(docs, "doc_id").collect()
    held = [r for r in out if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    odd = [(1, None), (2, ""), (3, " 123 !? "), (None, "the thing that was there"), (5, "ä")]
    found = predict_language(spark.createDataFrame(odd, "doc_id long, text string"), model).collect()
    assert {r.doc_id for r in found if r.lang_pred == "und"} == {1, 2, 3}
    assert all(0 <= r.score <= 1 for r in found) and all(r.score == 0 for r in found if r.lang_pred == "und")


def test_windows_cover_the_whole_text():
    assert cut(b"", 4).tolist() == [[0] * 4]
    assert cut(b"abc", 4).tolist() == [[97, 98, 99, 0]]
    assert [bytes(w) for w in cut(b"abcdefghij", 4)] == [b"abcd", b"efgh", b"ghij"]
    assert len(cut(b"x" * 10_000, 100)) == 100


def test_network_learns_byte_patterns():
    draw = np.random.default_rng(0)
    windows = draw.integers(97, 123, (600, 32)).astype(np.uint8)
    labels = draw.integers(0, 2, 600)
    windows[labels == 1, 5:8] = np.frombuffer(b"qzq", np.uint8)
    model = ByteCNN(["a", "b"], 32).fit(windows[:500], labels[:500])
    assert (model.logits(windows[500:]).argmax(axis=1) == labels[500:]).mean() > 0.95


def test_quality_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    vectors = word_vectors(docs)
    net = train_quality_model(docs, labels, vectors, ~held_out)
    out = score_quality(docs.withColumn("score", F.lit(1)), vectors, net).join(labels, "doc_id").filter(held_out).collect()
    good, bad = ([r.score for r in out if r.quality == q] for q in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.95 and np.mean([s >= 0.3 for s in good]) > 0.97
    odd = spark.createDataFrame([(None, None), (1, ""), (2, "word " * 100_000)], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in score_quality(odd, vectors, net).collect()}
    assert scores[None] == scores[1] and all(0 <= s <= 1 for s in scores.values())


def test_temperature_calibrates():
    draw = np.random.default_rng(4)
    x = draw.normal(size=(4000, 3))
    chance = 1 / (1 + np.exp(-2 * x[:, 0]))
    y = (draw.random(4000) < chance).astype(float)
    net = TwoLayerNet(3).fit(x[:2000], y[:2000], epochs=10)
    net.params["w2"] *= 6  # overconfident
    net.params["b2"] *= 6
    net.calibrate(x[2000:], y[2000:])
    assert net.temperature > 3 and np.abs(net(x[2000:]) - chance[2000:]).mean() < 0.08


def plain_words(text):
    """Runs of letters, digits or other signs, one byte at a time."""
    out, last = [], None
    for b in (text or "").encode():
        kind = 0 if b in b" \t\n\r\x0b\x0c" else 1 if b >= 128 or chr(b).isalpha() else 2 if chr(b).isdigit() else 3
        if kind:
            if kind == last:
                out[-1] += bytes([b])
            else:
                out.append(bytes([b]))
        last = kind
    return out


def plain_hash(word):
    return int(word_hashes(np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)]))[0])


def plain_vectors(texts, most):
    """Random indexing with dictionaries."""
    counts = Counter(w for t in texts for w in plain_words(t))
    often = sorted((w for w in counts if counts[w] >= 5), key=lambda w: (-counts[w], np.array([plain_hash(w)], np.uint64).view(np.int64)[0]))
    sums = {w: [0] * DIMS for w in often[:most]}
    for t in texts:
        words = plain_words(t)
        for i, w in enumerate(words):
            for j in (i - 2, i - 1, i + 1, i + 2):
                if w in sums and 0 <= j < len(words):
                    h = plain_hash(words[j])
                    plus = h % DIMS
                    sums[w][plus] += 1
                    sums[w][(plus + 1 + (h >> 32) % (DIMS - 1)) % DIMS] -= 1
    lengths = {w: math.sqrt(sum(x * x for x in v)) for w, v in sums.items()}
    return {w: [x / max(lengths[w], 1e-9) for x in v] for w, v in sums.items()}


def plain_features(text, vectors):
    words = plain_words(text)
    n, own = len(words), [vectors.get(w, [0.0] * DIMS) for w in words]
    mean = [sum(v[k] for v in own) / max(n, 1) for k in range(DIMS)]
    spread = [math.sqrt(max(sum(v[k] ** 2 for v in own) / max(n, 1) - mean[k] ** 2, 0)) for k in range(DIMS)]
    alike = [sum(sum(a * b for a, b in zip(own[i], own[i + s])) for i in range(n - s)) / max(n - s, 1) for s in (1, 2)]
    concentration = math.sqrt(sum(c * c for c in Counter(words).values())) / max(n, 1)
    rare = sum(w not in vectors for w in words) / max(n, 1)
    return [*mean, *spread, concentration, *alike, rare, math.log1p(n) / 10]


def plain_score(net, x):
    p = net.params
    z = [(a - m) / s for a, m, s in zip(x, net.mean, net.scale)]
    hidden = [math.tanh(sum(a * w for a, w in zip(z, column)) + b) for column, b in zip(p["w1"].T, p["b1"])]
    return 1 / (1 + math.exp(-(sum(h * w for h, w in zip(hidden, p["w2"])) + p["b2"][0]) / net.temperature))


@pytest.mark.parametrize("piece", [4 << 20, 300])
def test_quality_scores_equal_plain_ones(spark, monkeypatch, piece):
    monkeypatch.setattr(quality_model, "_PIECE", piece)
    monkeypatch.setattr(quality_model, "_SPLIT", piece)
    texts = [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").select("text").limit(60).collect()]
    texts += [None, "", " \n", "one", "Ünï 12ab --x", "a a a " * 200, texts[0]]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n int").repartition(3)
    vectors, wanted = word_vectors(docs, most=80), plain_vectors(texts, 80)
    assert len(vectors.words) == len(wanted) == 80
    labels = spark.createDataFrame([(i, i % 3 % 2) for i in range(len(texts))], "doc_id long, quality int")
    net = train_quality_model(docs, labels, vectors, F.lit(True))
    features = [plain_features(t, wanted) for t in texts]
    assert np.allclose(pooled([None if t is None else t.encode() for t in texts], vectors), features, atol=1e-6)
    scores = {r.doc_id: r.score for r in score_quality(docs, vectors, net).collect()}
    assert all(abs(scores[i] - plain_score(net, x)) < 1e-4 for i, x in enumerate(features))


def test_samples_stay_bounded_where_a_third_of_the_rows_is_equal(spark, monkeypatch):
    texts = [f"this is text number {i} with some words of its own" for i in range(200)] + ["one text that is everywhere"] * 100
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    seen = []
    monkeypatch.setattr(ByteCNN, "fit", lambda self, windows, labels, **_: seen.append(len(windows)) or self)
    train_language_model(docs, F.lit(True), per_language=1000)
    assert seen == [201]
    rows = [(1, "repeated " * 20)] * 150 + [(i, f"text {i}") for i in range(2, 60)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)] + [(1, 1)] * 50, "doc_id long, quality int")
    monkeypatch.setattr(TwoLayerNet, "fit", lambda self, x, y, **_: seen.append(len(x)) or self)
    monkeypatch.setattr(TwoLayerNet, "calibrate", lambda self, x, y: seen.append(len(x)) or self)
    train_quality_model(table, labels, word_vectors(table), F.lit(True))
    assert sum(seen[1:]) == 59


def test_language_scores_equal_plain_ones(spark):
    """Embedding, convolution, pooling and softmax by loops, over a few documents."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(40)
    model = train_language_model(docs, F.lit(True), per_language=20)
    p, size, top = model.params, model.size, 4
    out = {r.doc_id: r for r in predict_language(docs, model).collect()}
    for row in docs.orderBy(F.length("text")).limit(6).collect():
        data = row.text.lower().encode()
        n = model.window
        windows = [data[i : i + n] for i in range(0, len(data) - n + 1, n)] or [data + bytes(n - len(data))]
        if len(data) > n and len(data) % n:
            windows.append(data[-n:])
        logits = []
        for window in windows:
            best = []
            for f in range(model.filters * 3):
                width = (2, 3, 4)[f // model.filters]
                found = [
                    sum(p["embed"][window[i + k]][d] * p["conv"][k * size + d][f] for k in range(width) for d in range(size))
                    for i in range(n - top + 1)
                ]
                best.append(max(0.0, max(found) + p["bias"][f]))
            logits.append([sum(b * w for b, w in zip(best, column)) + s for column, s in zip(p["out"].T, p["shift"])])
        mean = [sum(column) / len(logits) for column in zip(*logits)]
        chances = [math.exp(v - max(mean)) for v in mean]
        assert out[row.doc_id].lang_pred == model.languages[max(range(len(mean)), key=mean.__getitem__)]
        assert abs(out[row.doc_id].score - max(chances) / sum(chances)) < 1e-4
