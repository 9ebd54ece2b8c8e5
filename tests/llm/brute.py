"""Plain versions of the operators, one document at a time, to compare with."""

import hashlib
import math
import re
import zlib
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def crc(ids):
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))


def token_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def pieces(ids, capacity=1024):
    """(start, ids): all pieces but the first hold `capacity` ids."""
    first = len(ids) % capacity or capacity
    cuts = [0, *range(min(first, len(ids)), len(ids) + 1, capacity)]
    return [(a, ids[a:b]) for a, b in zip(cuts, cuts[1:])]


def secrets(text):
    """{kind: [(start, end, value)]} of the base kinds."""
    assign = re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
    )
    text = text or ""
    return {
        "assign": [(m.start(), m.end(), m[2]) for m in assign.finditer(text) if len(m[2]) >= 6],
        "access": [(m.start(), m.end(), m[0]) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20],
        "hex": [(m.start(), m.end(), m[0]) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24],
    }


def span_text(spans):
    """spans: [(start, kind number, end)]."""
    kinds = ("assign", "access", "hex", "owned")
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(spans))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered.update(range(i, i + 8))
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": len(words) < 20 or 100 * len(covered) > 30 * len(words),
    }


def kept(text):
    """The verdict of the rules, by counting characters one by one."""
    text, found = text or "", quality(text)
    words, n = WORD.findall(text), found["n_words"]
    capitals = sum("A" <= c <= "Z" for c in text)
    letters = capitals + sum("a" <= c <= "z" for c in text)
    echoes = sum(a == b for a, b in zip(words, words[1:]))
    lines = sum(1 for x in text.split("\n") if WORD.search(x))
    return not (
        found["base_failed"] or 10 * found["n_symbols"] > n or found["word_chars"] > 25 * n or 2 * text.count("!") > n
        or (n >= 20 and 5 * capitals > 4 * letters) or 10 * found["n_dup_lines"] > 6 * lines or (n >= 20 and 3 * echoes > n)
    )


def fingerprint(text, shingle=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, fingerprints, radius=4):
    """Smallest id of each row's component."""
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fingerprints[i] ^ fingerprints[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for i, key in enumerate(ids):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return [least.get(find(i)) for i in range(len(ids))]


def top_k(vectors, k=10):
    """vectors: {id: list or None}."""
    good = {
        i: [math.floor(1024 * x) for x in v]
        for i, v in vectors.items()
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    rows = []
    for q, a in good.items():
        if q % 100 == 0:
            scores = sorted((-sum(map(int.__mul__, a, b)), i) for i, b in good.items() if i != q and len(a) == len(b))
            rows += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
    return sorted(rows)


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """sizes: {source: words}; rounds of sharing until no target is above its stop."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), share * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def line_dedup(pages, ratio=0.1, min_pages=2):
    """pages: [(host, text)]; the texts without boilerplate."""
    trim = lambda line: line.strip(" \t\r")
    on = Counter((h, line) for h, t in pages for line in {trim(x) for x in (t or "").split("\n")} if line)
    total = Counter(h for h, _ in pages)
    drop = {k for k, n in on.items() if n >= min_pages and n > ratio * total[k[0]]}
    return [
        None if t is None else "\n".join(x for x in t.split("\n") if (h, trim(x)) not in drop) for h, t in pages
    ]


def perspectives(turns, section=256):
    """turns: [(conv, turn, role, text)]; {(conv, section, assistant): (text, mask)}."""
    found = {}
    for conv in {t[0] for t in turns}:
        own = [t for t in turns if t[0] == conv]
        names = {("unknown" if t[2] is None else t[2]) for t in own} - {"system"}
        for part in {None if t[1] is None else t[1] // section for t in own}:
            said = [
                (t[1] is None, t[1] or 0, "unknown" if t[2] is None else t[2], t[3] or "")
                for t in own
                if (None if t[1] is None else t[1] // section) == part
            ]
            for name in names:
                text, mask = "", []
                for _, _, role, body in sorted(said):
                    head = "assistant" if role == name else role if role == "system" else "user name=" + re.sub(r"[\s<>|]", "_", role)
                    text += f"<|im_start|>{head}\n"
                    body = re.sub(r"<(\|im_(?:start|end)\|>)", r"< \1", body) + "<|im_end|>"
                    if role == name:
                        mask.append(f"{len(text)}-{len(text) + len(body)}")
                    text += body + "\n"
                found[conv, part, name] = (text, ",".join(mask))
    return found


def collocations(rows, least, most_words=5, per_language=2000):
    """rows: (lang, text). (lang, rank, phrase, a, l, r, n, score)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, *words[i : i + k]) for k in range(1, most_words + 1) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in f.items() if a >= least and len(p) > 2}
    inside = {(p[0], *p[1:][i : i + k]) for p, a in candidates.items() for k in range(2, len(p) - 1) for i in range(len(p) - k)
              if 100 * a >= 100 * f[(p[0], *p[1:][i : i + k])]}
    found = []
    for (lang, *words), a in candidates.items():
        if (lang, *words) in inside:
            continue
        cuts = [(f[(lang, *words[:k])], f[(lang, *words[k:])], k) for k in range(1, len(words))]
        score, k, left, right = min((1000 * a * n[lang] // (x * y), k, x, y) for x, y, k in cuts)
        found.append((lang, -score, -a, " ".join(words).encode(), left, right))
    ranks, out = Counter(), []
    for lang, score, a, phrase, left, right in sorted(found):
        ranks[lang] += 1
        if ranks[lang] <= per_language:
            out.append((lang, ranks[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return out


def substrings(rows, length=20):
    """rows: (id, text). (id, words, removed words, sha256 of the kept ones) per row; equal rows are one document."""
    seen, verdict = set(), {}
    for key in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        words, gone = WORD.findall(key[1] or ""), set()
        for i in range(len(words) - length + 1):
            window = tuple(words[i : i + length])
            if window in seen:
                gone.update(range(i, i + length))
            seen.add(window)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        verdict[key] = (key[0], len(words), len(gone), sha(kept))
    return [verdict[r] for r in rows]


def hard_negatives(rows, k=5, least=80):
    """rows: (id, label, vector), ids divisible by 100 are anchors. (anchor, positive, rank, negative, two scores)."""
    scaled = [(i, label, [math.floor(256 * float(x)) for x in v]) for i, label, v in rows]
    out = []
    for own, kind, anchor in (r for r in scaled if r[0] % 100 == 0):
        scores = sorted(((-sum(a * b for a, b in zip(anchor, v)), i, label) for i, label, v in scaled if len(v) == len(anchor)))
        positives = [(-s, i) for s, i, label in scores if label == kind and i != own][:k]
        for top, positive in positives:
            window = [(-s, i) for s, i, label in scores if label != kind and least * top <= -100 * s <= 100 * top][:k]
            out += [(own, positive, rank, i, top, s) for rank, (s, i) in enumerate(window, 1)]
    return sorted(out)
