"""Plain versions of the operators' rules, for small inputs."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

SPACE = re.compile(rb"[^\x20\x09-\x0D]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def byte_repeats(rows, width=200):
    """op6: doc_id -> (n_bytes, n_removed, n_spans, sha) for unique doc_ids."""
    data = {d: (t or "").encode() for d, t in rows}
    seen = Counter(b[i : i + width] for b in data.values() for i in range(len(b) - width + 1))
    out = {}
    for d, b in data.items():
        gone = [False] * len(b)
        end = 0
        for i in range(len(b) - width + 1):
            if seen[b[i : i + width]] > 1:
                for k in range(max(i, end), i + width):
                    gone[k] = True
                end = i + width
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[d] = (len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g)))
    return out


def word_repeats(rows, width=20):
    """op9: doc_id -> (n_words, n_removed, sha)."""
    words = {d: SPACE.findall((t or "").encode()) for d, t in rows}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - width + 1):
            first.setdefault(tuple(words[d][i : i + width]), (d, i))
    out = {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - width + 1):
            if first[tuple(w[i : i + width])] != (d, i):
                gone.update(range(i, i + width))
        out[d] = (len(w), len(gone), sha(b" ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contract_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def contamination(rows, items, window=13):
    """op3: doc_id -> (n_words, n_hit, n_items, sha, contaminated)."""
    windows = defaultdict(set)
    for item, text in items:
        words = contract_words(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows[tuple(words[i : i + size])].add(str(item))
    sizes = sorted({len(w) for w in windows})
    out = {}
    for d, text in rows:
        words, hit, names = contract_words(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                found = windows.get(tuple(words[i : i + size]))
                if found:
                    hit.update(range(i, i + size))
                    names |= found
        n = len(hit)
        out[d] = (len(words), n, len(names), sha(",".join(sorted(names)).encode()), n > 0 and 20 * n >= len(words))
    return out


def fingerprint(text):
    import xxhash

    words = [w.lower() for w in SPACE.findall((text or "").encode())]
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)]
    if not words:
        return 0
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42)
        for k in range(64):
            ones[k] += h >> k & 1
    return sum(1 << k for k in range(64) if 2 * ones[k] > len(grams))


def near_duplicates(rows, radius=3):
    """op10: doc_id -> (fingerprint, component_id) for unique doc_ids."""
    fps = {d: fingerprint(t) for d, t in rows}
    root = {f: f for f in fps.values()}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    distinct = sorted(root)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    least = {}
    for d, f in fps.items():
        r = find(f)
        least[r] = min(least.get(r, d), d)
    return {d: (f"{f:016x}", least[find(f)]) for d, f in fps.items()}


def rule_counts(text):
    """op7: (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    split = re.compile(r"[^\x20\x09-\x0D]+")
    text = text or ""
    words = split.findall(text)
    three = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if three[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if split.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


def token_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def hard_negatives(rows, k=5):
    """op11: (anchor, positive, rank, negative, positive score, negative score) for (vec_id, vector, label)."""
    kept = []
    for v, e, label in rows:
        if None in (v, e, label) or any(x is None or not math.isfinite(x) for x in e):
            continue
        kept.append((v, (label + 1) % 10 if v % 7 == 0 else label, [math.floor(256 * x) for x in e]))
    out = []
    for i, (v, label, q) in enumerate(kept):
        if v % 100:
            continue
        score = [sum(a * b for a, b in zip(q, other)) for *_, other in kept]
        order = sorted(range(len(kept)), key=lambda j: (-score[j], kept[j][0], j))
        for p in [j for j in order if j != i and kept[j][1] == label][:k]:
            fits = [j for j in order if kept[j][1] != label and 80 * score[p] <= 100 * score[j] <= 100 * score[p]]
            out += [(v, kept[p][0], n + 1, kept[j][0], score[p], score[j]) for n, j in enumerate(fits[:k])]
    return sorted(out)


def shingle_set(text, size=4):
    words = SPACE.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) or frozenset([tuple(words)])


def similar(a, b, percent=80):
    both = len(a & b)
    return bool(a and b) and 100 * both >= percent * (len(a) + len(b) - both)


def shingle_duplicates(rows):
    """op12: (doc_id, n_shingles, component_id, kept) for unique doc_ids."""
    sets = {d: shingle_set(t) for d, t in rows}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in itertools.combinations(sets, 2):
        if similar(sets[a], sets[b]):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return sorted((d, len(s), find(d), find(d) == d) for d, s in sets.items())


def merkle(rows, arity=2):
    """op13: (doc_id, leaf, subroot, root, proof sha, folded root, verified) for rows as dictionaries."""

    def hashed(text):
        return sha(text.encode())

    def leaf(r):
        parts = ("-" if r[n] is None else f"{len(str(r[n]).encode())}:{r[n]}" for n in ("doc_id", "source", "lang", "n_chars", "text"))
        return hashed("".join(parts))

    def tree(level):
        levels = [level]
        while len(levels[-1]) > 1:
            below = levels[-1]
            levels.append([hashed("".join(below[i : i + arity])) for i in range(0, len(below), arity)])
        return levels

    def siblings(levels, i):
        for level in levels[:-1]:
            first = i // arity * arity
            yield "".join(level[first:i]), "".join(level[i + 1 : first + arity])
            i //= arity

    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r["lang"]].append(r)
    langs = sorted(by_lang, key=lambda name: (name is not None, (name or "").encode()))
    trees = {}
    for name in langs:
        own = sorted(by_lang[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[name] = own, tree([leaf(r) for r in own])
    top = tree([trees[name][1][-1][0] for name in langs])
    out = []
    for k, name in enumerate(langs):
        own, levels = trees[name]
        for i, r in enumerate(own):
            proof = [*siblings(levels, i), *siblings(top, k)]
            changed = dict(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["n_chars"] is not None:
                changed["n_chars"] += 1
            value = leaf(changed)
            for left, right in proof:
                value = hashed(left + value + right)
            flat = "".join(left + right for left, right in proof)
            out.append((r["doc_id"], levels[0][i], levels[-1][0], top[-1][0], hashed(flat), value, value == top[-1][0]))
    return sorted(out, key=str)
