"""Plain versions of the operators, and documents with every awkward case."""

import hashlib
import re

import xxhash

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
LEAST = -(1 << 63)

_RUN = " ".join(f"word{i} of a passage" for i in range(60))
_LONG = "\n".join(f"line {i % 37} of a long text with {i} words" for i in range(900))

#: (doc_id, text): nulls, empty and blank texts, repeated rows, one id with
#: two texts, copies, near copies, shared passages, very long and odd texts.
AWKWARD = [
    (5, _RUN), (6, "Before. " + _RUN + " After."), (7, _RUN), (1, None), (2, ""), (None, "A text without an id. " + _RUN[:150]), (None, None),
    (8, " \t\n  "), (9, _LONG), (9, _LONG), (9, "Another text of the same id.\nIt has two lines."), (10, _LONG.replace("line 7 ", "LINE 7 ")),
    (11, "a" * 5000), (12, "a" * 777), (13, "ΣΑΣ İstanbul ẞ 日本語 😀👍🏽 é \x00\x1c\x85 it's we'll 'dog' <|endoftext|>x<|startoftext|> ​"),
    (14, "x"), (15, "one two"), (16, "One  TWO"), (-3, "a negative id.\nIt has two lines.\n\nIt has two lines.\n"), (17, "Another text of the same id.\nIt has two lines."),
    (18, "\n\n\n"), (19, _RUN[:99]), (20, _RUN[:100]), (21, "é" * 120), (22, "word1 of a passage word2 of a passage word3 of a passage word4 of it"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows(pairs=AWKWARD):
    return [(d, t, None if d is not None and d % 5 == 0 else "en", None if d is None else f"src{d % 3}",
             None if t is None else len(t)) for d, t in pairs]


def frame(spark, pairs=AWKWARD):
    return spark.createDataFrame(rows(pairs), SCHEMA).repartition(3)


def order(d):
    return LEAST if d is None else d


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def removed_bytes(pairs, length):
    """[(doc_id, n_bytes, n_removed, n_spans, kept_sha256)], sorted."""
    seen, out = set(), []
    for d, t in sorted((order(d), (t or "").encode()) for d, t in pairs):
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            s = t[p:p + length]
            if s in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(s)
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((None if d == LEAST else d, len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept)))
    return sorted(out, key=repr)


def benchmark_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(pairs, items, window=13, share=20):
    windows = {}
    for item, text in items:
        w = benchmark_words(text)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).update([] if item is None else [str(item)])
    out = []
    for d, t in pairs:
        w, hit, found = benchmark_words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and share * len(hit) >= len(w)))
    return sorted(out, key=repr)


def simhash(text, shingle=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return 0
    n = min(shingle, len(w))
    h = [xxhash.xxh64_intdigest(" ".join(w[k:k + n]).encode(), 42) for k in range(len(w) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(keys, near):
    """Root of each key, by comparing all pairs."""
    keys = list(keys)
    parent = list(range(len(keys)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(keys)):
        for j in range(i):
            if near(keys[i], keys[j]):
                parent[top(i)] = top(j)
    return {k: top(i) for i, k in enumerate(keys)}


def near_copies(pairs, radius=3):
    prints = [simhash(t) for _, t in pairs]
    roots = components(set(prints), lambda a, b: (a ^ b).bit_count() <= radius)
    low = {}
    for (d, _), p in zip(pairs, prints):
        if d is not None:
            low[roots[p]] = min(low.get(roots[p], d), d)
    return sorted(((d, f"{p:016x}", low.get(roots[p])) for (d, _), p in zip(pairs, prints)), key=repr)


def line_copies(pairs, min_lines=2, min_words=50):
    """By (doc_id, text): the runs [start, end) from each line that also start
    earlier, the longest each, of ``min_lines`` lines or ``min_words`` words."""
    seen, out = set(), {}
    docs = sorted({(order(d), t) for d, t in pairs if t}, key=lambda x: (x[0], text_hash(x[1])))
    for d, t in docs:
        lines, out[d, t] = t.split("\n"), []
        for i in range(len(lines)):
            n = 0
            while i + n < len(lines) and tuple(lines[i:i + n + 1]) in seen:
                n += 1
            words = sum(len(re.findall(r"[^\x20\x09-\x0d]+", x)) for x in lines[i:i + n])
            if n and (n >= min_lines or min_words is not None and words >= min_words):
                out[d, t].append((i, i + n))
            seen.update(tuple(lines[i:e]) for e in range(i + 1, len(lines) + 1))
    return out


def deleted_lines(pairs, min_lines=2, min_words=50):
    """By (doc_id, text): the set of deleted line numbers."""
    return {k: {i for a, b in runs for i in range(a, b)} for k, runs in line_copies(pairs, min_lines, min_words).items()}


def text_hash(text):
    """Spark's xxhash64 of a string, signed."""
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def line_report(pairs, min_lines=2, min_words=50):
    copies, out = line_copies(pairs, min_lines, min_words), []
    for d, t in pairs:
        lines = t.split("\n") if t else []
        runs = copies.get((order(d), t), [])
        whole = [r for r in runs if not any(o != r and o[0] <= r[0] and r[1] <= o[1] for o in runs)]
        cut = {i for a, b in runs for i in range(a, b)}
        kept = "\n".join(x for i, x in enumerate(lines) if i not in cut)
        out.append((d, len(lines), len(cut), len(whole), max([b - a for a, b in whole], default=0), sha(kept)))
    return sorted(out, key=repr)
