"""Substring, line and suffix-array deduplication against brute force."""

import hashlib
import random

import numpy as np
import pytest
from conftest import plan_of
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm.chunks import Repeats, decode, encode, filled_shards, note_batch, slice_of, split_note
from millrace.llm.hashing import Windows, word_hashes
from millrace.llm.lines import drop_frequent_lines
from millrace.llm.perfect_hash import PerfectHash
from millrace.llm.substrings import level_lengths, remove_repeated_windows
from millrace.llm.suffixes import BlindTrie, deep_shallow_order, remove_earlier_strings

random.seed(5)
VOCABULARY = [f"wört{i}" if i % 7 == 0 else f"w{i}" for i in range(300)]
PASSAGES = [[random.choice(VOCABULARY) for _ in range(n)] for n in (36, 60, 34, 35, 120)]


def sample_texts() -> list:
    texts = []
    for _ in range(60):
        words = []
        for _ in range(random.randint(0, 4)):
            words += [random.choice(VOCABULARY) for _ in range(random.randint(0, 60))]
            if random.random() < 0.6:
                words += random.choice(PASSAGES)
        texts.append("".join(w + random.choice([" ", "  ", "\n", "\t"]) for w in words))
    texts += [texts[3], texts[3], "", None, " \n ", "ab " * 400, "=" * 700, "z", texts[5][:250]]
    return texts


TEXTS = sample_texts()


def frame(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, "x", i) for i, t in enumerate(texts)]
    # Further columns carry names that the operators use inside.
    schema = "doc_id long, text string, chunk string, n_words int"
    return spark.createDataFrame(rows, schema).repartition(3)


def removed_windows(texts, window):
    split = [(t or "").encode().split() for t in texts]
    seen = {}
    for d, w in enumerate(split):
        for i in range(len(w) - window + 1):
            seen.setdefault(tuple(w[i : i + window]), []).append((d, i))
    gone = [set() for _ in texts]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d].update(range(i, i + window))
    return [
        (d, b" ".join(x for i, x in enumerate(w) if i not in gone[d]).decode(), len(w), len(gone[d]))
        for d, w in enumerate(split)
    ]


@pytest.mark.parametrize("chunk_bytes", [600, 1 << 22])
@pytest.mark.parametrize("window", [35, 12])
def test_substrings_match_brute_force(spark, staging, chunk_bytes, window):
    out = remove_repeated_windows(frame(spark, TEXTS), staging, window=window, chunk_bytes=chunk_bytes).collect()
    assert sorted(map(tuple, out)) == removed_windows(TEXTS, window)


def test_answers_of_earlier_levels_are_not_read_again(spark, staging):
    out = remove_repeated_windows(frame(spark, TEXTS), staging, window=35)
    assert plan_of(out).count("SortMergeJoin") == 1  # 4 when each pass worked all levels out again


def test_notes_come_back_among_the_answers():
    chunk = type("C", (), {"number": 7 << 33})
    bits = np.array([3, 0, 255], np.uint8)
    (row,) = note_batch(chunk, bits).to_pylist()
    assert row["shard"] < 0 and row["chunk"] == chunk.number
    note, answers = split_note([(0, b"a"), (row["shard"], row["part"]), (5, b"b")])
    assert note[0].tolist() == bits.tolist() and answers == [(0, b"a"), (5, b"b")]
    assert split_note([(0, b"a")]) == (None, [(0, b"a")])


def test_a_shard_looks_each_key_up_once(monkeypatch):
    """300 chunks of 10 keys: 3,000 lookups, not all shared keys in every chunk."""
    level = Repeats(3000, 64)
    keys = [np.sort(np.arange(10, dtype=np.uint64) * np.uint64(1000) + np.uint64(i // 2)) for i in range(300)]
    parts = [b.column("part")[0].as_py() for i, k in enumerate(keys) for b in level.ask(type("C", (), {"number": i}), k)]
    looked, search = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda a, v, *x, **y: looked.append(np.size(v)) or search(a, v, *x, **y))
    replies = dict(level.reduce(list(range(300)), parts))
    assert sum(looked) <= 3000
    assert len(replies) == 300 and all(level.flags(k, [(0, replies[i])])[0].all() for i, k in enumerate(keys))


def test_levels_double():
    assert level_lengths(35) == [9, 18, 35]
    assert level_lengths(8) == [8]
    for window in range(1, 200):
        lengths = level_lengths(window)
        assert lengths[-1] == window and all(a < b <= 2 * a for a, b in zip(lengths, lengths[1:], strict=False))


def line_result(texts, copies, least=40):
    keyed = [[x.strip(" \t\n\r\x0b\x0c") for x in (t or "").split("\n")] for t in texts]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    keyed = [[k.translate(lower) for k in keys] for keys in keyed]
    docs = {}
    for d, keys in enumerate(keyed):
        for k in keys:
            if len(k) >= least:
                docs.setdefault(k, set()).add(d)
    out = []
    for d, keys in enumerate(keyed):
        drop = [len(docs.get(k, ())) >= copies and max(docs[k]) != d for k in keys]
        kept = [x for x, gone in zip((texts[d] or "").split("\n"), drop, strict=True) if not gone]
        out.append((d, "\n".join(kept), len(keys), sum(drop)))
    return out


def line_texts():
    common = [f"Line number {i} is held by many documents ä" for i in range(8)] + ["short line", "ö" * 40, "ö" * 39, ""]
    texts = []
    for _ in range(80):
        lines = [random.choice(common) for _ in range(random.randint(0, 6))]
        lines += [f"  {x.upper()}\t" if random.random() < 0.3 else x for x in random.sample(common, 2)]
        texts.append("\n".join(lines))
    return [*texts, None, "", "\n\n", "x" * 90, "x" * 90]


@pytest.mark.parametrize("chunk_bytes", [300, 1 << 22])
def test_lines_match_brute_force(spark, staging, chunk_bytes):
    texts = line_texts()
    out = drop_frequent_lines(frame(spark, texts), staging, chunk_bytes=chunk_bytes).collect()
    assert sorted(map(tuple, out)) == line_result(texts, 5)


def test_lines_carry_other_columns(spark, staging):
    texts = line_texts()
    out = drop_frequent_lines(frame(spark, texts), staging, chunk_bytes=500, carry=("chunk", "n_words")).collect()
    assert {r["doc_id"]: r["rest"]["n_words"] for r in out} == {i: i for i in range(len(texts))}
    assert {r["rest"]["chunk"] for r in out} == {"x"}


def earlier_strings(rows, window):
    """Rows of (id, text) in order of their ids."""
    seen, out = set(), []
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - window + 1):
            part = data[p : p + window]
            if part in seen:
                gone[p : p + window] = b"\1" * window
            seen.add(part)
        kept = bytes(c for c, x in zip(data, gone, strict=True) if not x)
        spans = sum(1 for p in range(len(gone)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i, hashlib.sha256(kept).hexdigest(), len(data), sum(gone), spans))
    return out


@pytest.mark.parametrize(("chunk_bytes", "dense"), [(500, 4096), (500, 4), (2000, 8), (1 << 22, 4096), (1 << 22, 4)])
@pytest.mark.parametrize("window", [100, 50])
def test_suffixes_match_brute_force(spark, staging, chunk_bytes, dense, window):
    ids = random.sample(range(1000), len(TEXTS))
    table, settings_ = frame(spark, TEXTS, ids), {"window": window, "chunk_bytes": chunk_bytes, "dense": dense}
    out = remove_earlier_strings(table, staging, **settings_).collect()
    got = sorted((r["doc_id"], hashlib.sha256(r["text"]).hexdigest(), *list(r)[2:5]) for r in out)
    assert got == earlier_strings(sorted(zip(ids, TEXTS, strict=True), key=lambda x: x[0]), window)
    for r in out:
        assert sum(e - s for s, e in r["spans"]) == r["n_removed"] and len(r["spans"]) == r["n_spans"]


@pytest.mark.parametrize("dense", [4096, 64])
@pytest.mark.parametrize("chunk_bytes", [3000, 40000])
def test_strings_in_many_surroundings(spark, staging, chunk_bytes, dense):
    """One attribute and one passage amid very many values: more surroundings than one key may hold."""
    attribute, passage = '" class="product-card product-card--', "An honest passage that stands in many documents. " * 4
    values = [hashlib.sha256(str(i % 500).encode()).hexdigest() for i in range(700)]
    texts = [f"{v[:30]}{attribute}{v}" + (f"{v[::-1]}{passage}{v[7:50]}" if i % 3 == 0 else "") for i, v in enumerate(values)]
    ids = random.sample(range(10000), len(texts))
    out = remove_earlier_strings(frame(spark, texts, ids), staging, chunk_bytes=chunk_bytes, dense=dense).collect()
    got = sorted((r["doc_id"], hashlib.sha256(r["text"]).hexdigest(), *list(r)[2:5]) for r in out)
    assert got == earlier_strings(sorted(zip(ids, texts, strict=True), key=lambda x: x[0]), 100)


def test_keys_in_many_forms_are_dense():
    """Forms are counted over all chunks, and those of a key alone in its chunk count too."""
    level, chunk = Repeats(10, 64, dense=10), type("C", (), {"number": 0})
    keys = [np.array([5] * 6 + [7] * 2 + [9] * 12, np.uint64), np.array([5] * 5 + [7], np.uint64)]
    forms = np.arange(20, dtype=np.uint64)
    asked = [next(level.ask(chunk, k, lambda own, k=k: forms[own])).column(2)[0].as_py() for k in keys]
    replies = dict(level.reduce([0, 1], asked))
    told = [level.flags(k, [(0, replies[i])]) for i, k in enumerate(keys)]
    assert [sorted(set(k[many].tolist())) for k, (_, many) in zip(keys, told, strict=True)] == [[5, 9], [5]]
    assert all(repeated.all() for repeated, _ in told)


@given(st.lists(st.integers(0, 2**64 - 1), max_size=60), st.integers(1, 40), st.sampled_from([20, 40, 64]))
@settings(max_examples=60, deadline=None)
def test_filled_shards_hold_all_keys_in_order(keys, shards, bits):
    keys = np.unique(np.array(keys, np.uint64) >> np.uint64(64 - bits))
    numbers, edges = filled_shards(keys, shards, bits)
    assert (np.diff(numbers) > 0).all() and edges[-1] == len(keys) and len(edges) == len(numbers) + 1
    assert all(0 <= s < shards and edges[i] < edges[i + 1] for i, s in enumerate(numbers))
    for i, s in enumerate(numbers.tolist()):
        own = slice_of(s, (numbers, edges))
        assert own == slice(edges[i], edges[i + 1])
        assert all(abs(int(k) * shards / 2**bits - s) < 1.001 for k in keys[own])


OPERATORS = [remove_repeated_windows, drop_frequent_lines, remove_earlier_strings]


@pytest.mark.parametrize("operator", OPERATORS)
def test_empty_table(spark, staging, operator):
    assert operator(frame(spark, TEXTS).filter("false"), staging).count() == 0


@pytest.mark.parametrize("operator", OPERATORS)
def test_null_ids_and_texts(spark, staging, operator):
    long = " ".join(VOCABULARY)
    docs = spark.createDataFrame([(None, long), (None, None), (3, long), (3, None)], "doc_id long, text string")
    out = operator(docs, staging).collect()
    assert sorted(str(r["doc_id"]) for r in out) == ["3", "3", "None", "None"]
    if operator is remove_earlier_strings:  # a null id comes first, so its text stays
        assert {(r["doc_id"], len(r["text"])) for r in out} == {(None, len(long.encode())), (None, 0), (3, 0)}


@pytest.mark.parametrize("chunk_bytes", [4 << 20, 1])
def test_rows_of_one_id_are_one_document(spark, staging, chunk_bytes):
    """Ids are counted, not rows, also where they meet from many chunks."""
    line, other = ("a line of more than forty characters, held by one document", "another line that is as long as it has to be")
    rows = [(1, line)] * 4 + [(2, line)] + [(k, f"{other}\n{line if k > 90 else k}") for k in (7, 8, 9, 9, 10, 11, 11, 91, 92)]
    docs = spark.createDataFrame(rows + [(None, other), (None, other)], "doc_id long, text string").repartition(3)
    out = sorted(map(tuple, drop_frequent_lines(docs, staging, chunk_bytes=chunk_bytes).collect()), key=repr)
    wanted = [(1, line, 1, 0)] * 4 + [(2, line, 1, 0), *[(k, str(k), 2, 1) for k in (7, 8, 9, 9, 10, 11, 11)]]
    wanted += [(91, line, 2, 1), (92, f"{other}\n{line}", 2, 0), (None, "", 1, 1), (None, "", 1, 1)]
    assert out == sorted(wanted, key=repr)


@given(st.lists(st.integers(0, 2**64 - 1), unique=True, max_size=400))
@settings(max_examples=40, deadline=None)
def test_perfect_hash_is_minimal(keys):
    keys = np.array(keys, np.uint64)
    assert sorted(PerfectHash(keys)(keys).tolist()) == list(range(len(keys)))


@given(st.lists(st.binary(min_size=24, max_size=24), max_size=60), st.sampled_from([0, 8, 16, 24]))
@settings(max_examples=60, deadline=None)
def test_deep_shallow_order_sorts(rows, shallow):
    rows = rows + [bytes(20) + r[:4] for r in rows] + rows[:5]
    table = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 24) if rows else np.zeros((0, 24), np.uint8)
    assert deep_shallow_order(table, shallow).tolist() == sorted(range(len(rows)), key=lambda i: (rows[i], i))


@given(st.sets(st.binary(min_size=5, max_size=5), max_size=60))
@settings(max_examples=60, deadline=None)
def test_blind_trie_orders(strings):
    trie = BlindTrie()
    for s in strings:
        trie.insert(s)
    assert list(trie.in_order()) == sorted(strings)


def test_arrays_travel_whole():
    arrays = [np.arange(300, dtype=np.uint32), np.array([-1, 5], np.int64), np.zeros(0, np.uint8)]
    back = decode(encode(*arrays))
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, back, strict=True))
    keys = np.unique(np.random.default_rng(1).integers(0, 2**64, 1000, dtype=np.uint64))
    shards, edges = filled_shards(keys, 7)
    assert edges[0] == 0 and edges[-1] == len(keys)
    assert [int(k) * 7 >> 64 for k in keys] == np.repeat(shards, np.diff(edges)).tolist()


def test_windows_that_collide_under_polynomials_stay(spark, staging):
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, "same " * 34 + word), (2, "same " * 34 + other)]
    out = remove_repeated_windows(spark.createDataFrame(rows, "doc_id long, text string"), staging).collect()
    assert [r["n_removed"] for r in out] == [0, 0]


def test_word_hashes_tell_words_apart():
    texts = [b"a", b"b", b"ab", b"a" * 7, b"a" * 8, b"a" * 9, b"a" * 255, b"a" * 256, b"a" * 257, b"\x00", b"\x00\x00", b"a" * 8 + b"\x00"]
    data = np.frombuffer(b" ".join(texts), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    starts = ends - [len(t) for t in texts]
    one, two = word_hashes(data, starts, ends), word_hashes(data, starts, ends, 1)
    assert len(set(one) | set(two)) == 2 * len(texts)
    again = np.frombuffer(b"xyz" + data.tobytes(), np.uint8)
    assert (word_hashes(again, starts + 3, ends + 3) == one).all()
    windows = Windows(one)
    assert [len(windows(n)) for n in (1, 2, 5, 12, 13, 35)] == [12, 11, 8, 1, 0, 0]
