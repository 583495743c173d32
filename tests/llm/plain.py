"""The pipeline's stages on plain lists of (doc_id, text, source), for comparison."""

import base64
import hashlib
import math
from collections import Counter

import numpy as np
import public_tokenizers
import regex
import tiktoken

from millrace.llm.quality_rules import fit_votes

SPACE = " \t\n\r\x0b\x0c"
_WORD = regex.compile(r"[^\x20\x09-\x0D]+")
_MARKED = regex.compile(r"^[^\p{L}\p{N}]+$|([^\p{L}\p{N}])\1$")


def text_counts(text):
    words = _WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if _WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
        "n_letters": len(regex.findall(r"\p{L}", text or "")),
        "n_capitals": len(regex.findall(r"\p{Lu}", text or "")),
        "n_marked": sum(bool(_MARKED.search(w)) for w in words),
        "n_stutter": sum(a == b for a, b in zip(words, words[1:], strict=False)),
        "n_distinct": len(set(words)),
    }


def votes(c):
    over = lambda part, percent, whole: c[part] * 100 > c[whole] * percent
    prose = (
        not over("n_symbols", 2, "n_words")
        and not over("n_repeat_words", 5, "n_words")
        and not over("n_stutter", 5, "n_words")
        and not over("n_capitals", 20, "n_letters")
        and not over("n_marked", 10, "n_words")
        and over("n_letters", 80, "word_chars")
    )
    length, n = c["word_chars"], c["n_words"]
    return {
        "symbols": -over("n_symbols", 10, "n_words"),
        "repeats": -(over("n_repeat_words", 20, "n_words") and c["n_repeat_words"] >= 60),
        "stutter": -over("n_stutter", 25, "n_words"),
        "dup_lines": -(over("n_dup_lines", 30, "n_lines") and c["n_lines"] >= 4),
        "capitals": -over("n_capitals", 50, "n_letters"),
        "marks": -over("n_marked", 25, "n_words"),
        "letters": -over("word_chars", 166, "n_letters"),
        "word_length": -1 if length < 2 * n or length > 15 * n else int(3 * n <= length <= 10 * n and prose),
        "vocabulary": -1 if over("n_words", 1000, "n_distinct") else int(over("n_distinct", 25, "n_words") and prose),
        "prose": int(prose and n > 0),
    }


def base_failed(c):
    return c["n_words"] < 20 or 100 * c["n_repeat_words"] > 30 * c["n_words"]


def kept_by_rules(docs):
    counts = [text_counts(t) for _, t, _ in docs]
    cast = [votes(c) for c in counts]
    rules = list(cast[0]) if cast else []
    patterns = Counter(tuple(v[r] for r in rules) for v in cast)
    model = fit_votes(list(patterns.items()), rules)
    keep = []
    for doc, c, v in zip(docs, counts, cast, strict=True):
        logit = math.log(model.balance / (1 - model.balance)) + sum(v[r] * model.weight(r) for r in rules)
        if not base_failed(c) and 1 / (1 + math.exp(-logit)) >= 0.5:
            keep.append(doc)
    return keep


def without_frequent_lines(docs, copies=5, least=40):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(SPACE).translate(lower)
    holders = {}
    for i, t, _ in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t, source in docs:
        kept = [x for x in (t or "").split("\n") if len(h := holders.get(key(x), ())) < copies or max(h) == i]
        out.append((i, "\n".join(kept), source))
    return out


def without_near_copies(docs, size=5, percent=80):
    sets = []
    for _, t, _ in docs:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()})
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, one in enumerate(sets):
        for j in range(i):
            if one and sets[j] and 100 * len(one & sets[j]) >= percent * len(one | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for k, doc in enumerate(docs):
        least[find(k)] = min(least.get(find(k), doc[0]), doc[0])
    return [doc for k, doc in enumerate(docs) if least[find(k)] == doc[0]]


def earliest_deadline_first(quota):
    """The source of each slot of a period, one slot at a time."""
    n, done, out = sum(quota), [0] * len(quota), []
    for slot in range(n):
        released = [k for k, q in enumerate(quota) if done[k] < q and done[k] * n // q <= slot]
        pick = min(released, key=lambda k: (-(-(done[k] + 1) * n // quota[k]), k))
        out.append((pick, done[pick]))
        done[pick] += 1
    return out


def mixed(docs, block_rows=16):
    counts = Counter(source for _, _, source in docs)
    names = sorted(counts)
    weights = [math.isqrt(counts[name]) for name in names]
    quota = dict(zip(names, [w // math.gcd(*weights) for w in weights], strict=True))
    period = sum(quota.values())
    slots = {(names[s], b): t for t, (s, b) in enumerate(earliest_deadline_first(list(quota.values())))}
    order = sorted(docs, key=lambda d: (d[2], hashlib.md5(str(d[0]).encode()).hexdigest(), d[0]))
    seen, placed = Counter(), []
    for doc in order:
        block, place = divmod(seen[doc[2]], block_rows)
        seen[doc[2]] += 1
        turn = block // quota[doc[2]] * period + slots[doc[2], block % quota[doc[2]]]
        placed.append((turn, place, doc))
    return [doc for _, _, doc in sorted(placed, key=lambda x: x[:2])]


def encoding():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(docs, by=None):
    by = by or encoding()
    out = []
    for i, t, _ in docs:
        ids = by.encode_ordinary(t or "")
        raw = np.array(ids, "<u4").tobytes()
        digests = (hashlib.sha256(x).hexdigest() for x in (raw, (t or "").encode()))
        out.append((i, len(ids), raw, *digests))
    return out
