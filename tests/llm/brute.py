"""Plain versions of the operators, straight from their definitions, for small inputs."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter
from fractions import Fraction
from math import log

import duckdb
import pyarrow as pa
import regex
import xxhash

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
WORD8 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def substring(docs, size=13):
    """docs: (doc_id, text) -> doc_id, n_words, n_removed, sha of kept words."""
    words = [(d, SPACE.findall(t or "")) for d, t in docs]
    first = {}
    for d, w in words:
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            first[key] = min(d, first.get(key, d))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < d:
                gone.update(range(i, i + size))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), sha(" ".join(kept))))
    return sorted(out)


def simhash(text, size=4):
    words = SPACE.findall(lower(text or ""))
    if not words:
        return 0
    size = min(size, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + size]), 42) for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    """Smallest node reachable from each node over the pairs of ``linked``."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def near(docs, radius=4):
    prints = [(d, simhash(t)) for d, t in docs]
    by = {}
    for d, f in prints:
        by.setdefault(f, []).append(d)
    all_f = list(by)
    links = [(f, g) for i, f in enumerate(all_f) for g in all_f[:i] if (f ^ g).bit_count() <= radius]
    root = groups(all_f, links)
    least = {}
    for d, f in prints:
        least[root[f]] = min(d, least.get(root[f], d))
    return sorted((d, f"{f:016x}", least[root[f]]) for d, f in prints)


def shard(doc_id, count):
    def score(i):
        h = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), 42)
        h = xxhash.xxh64_intdigest(struct.pack("<i", i), h)
        return (1.0 / -log(((h >> 11) + 0.5) / 2.0**53), -i)

    return max(range(count), key=score)


def shards(docs, count=24):
    place, out = {}, []
    for d, t in sorted(docs, key=lambda r: r[0]):
        body = (t or "").encode()
        s = shard(d, count)
        place[s] = place.get(s, -1) + 1
        out.append((d, len(body) + 8, zlib.crc32(body), "key", s, place[s], shard(d, count + 1)))
    return sorted(out)


def benchmark(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = WORD8.findall(lower(text or ""))
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    lengths = {len(k) for k in windows}
    out = []
    for d, text in docs:
        w = WORD8.findall(lower(text or ""))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return sorted(out)


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def secrets(docs):
    """Base spans: doc_id, counts of the three kinds, sha of the listing, listing."""
    out = []
    for d, t in docs:
        t = t or ""
        found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        text = ",".join(f"{['assign', 'access', 'hex'][k]}:{a}:{b}" for a, k, b in sorted(found))
        out.append((d, *[sum(k == i for _, k, _ in found) for i in range(3)], sha(text), text))
    return sorted(out)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def line_form(line):
    return " ".join(regex.findall(r"[\p{L}\p{N}]+", line.lower()))


def alike(forms, similarity=0.8):
    """All pairs of forms of that edit similarity: every pair is looked at, by the database's own distance.

    It counts bytes, so characters become single bytes first. Two forms whose letter counts differ by
    more than twice the allowed distance in all cannot be within it.
    """
    forms = sorted(forms)
    chars = sorted({c for f in forms for c in f})
    if len(chars) > 120:
        far = lambda a, b: edit_distance(a, b) > int(max(len(a), len(b)) * (1 - similarity) + 1e-9)
        return [(a, b) for i, b in enumerate(forms) for a in forms[:i] if not far(a, b)]
    small = {c: chr(i + 1) for i, c in enumerate(chars)}
    coded = ["".join(map(small.__getitem__, f)) for f in forms]
    often = [c for c, _ in Counter("".join(coded)).most_common(24)]
    rows = pa.table({"id": range(len(coded)), "f": coded, "n": [len(f) for f in coded], **{f"c{k}": [f.count(c) for f in coded] for k, c in enumerate(often)}})
    con = duckdb.connect()
    con.register("rows", rows)
    allowed = f"floor(greatest(a.n, b.n) * {1 - similarity} + 1e-9)"
    apart = " + ".join(f"abs(a.c{k} - b.c{k})" for k in range(len(often))) or "0"
    found = con.execute(
        f"select a.id, b.id from rows a join rows b on a.id < b.id and b.n - a.n <= {allowed} and a.n - b.n <= {allowed} "
        f"where {apart} <= 2 * {allowed} and levenshtein(a.f, b.f) <= {allowed}"
    ).fetchall()
    return [(forms[a], forms[b]) for a, b in found]


def lines(docs, similarity=0.8):
    """doc_id, lines with words, lines that go, and these with their group's first occurrence; groups by edit similarity alone."""
    at = {}
    for d, t in docs:
        for i, line in enumerate(t.split("\n") if t else []):
            if form := line_form(line):
                at.setdefault(form, set()).add((d, i))
    node = {f: min(places) for f, places in at.items()}
    root = groups(node.values(), [(node[a], node[b]) for a, b in alike(node, similarity)])
    out = {d: [0, []] for d, _ in docs}
    for f, places in at.items():
        for d, i in places:
            out[d][0] += 1
            if (d, i) != root[node[f]]:
                out[d][1].append((i, *root[node[f]]))
    return sorted((d, n, len(g), ",".join("%d:%d:%d" % x for x in sorted(g))) for d, (n, g) in out.items())


def periodic_runs(w):
    """(start, length, period) of each run of four or more smallest periods and six or more words."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            part = w[i : j + q]
            if len(part) >= max(6, 4 * q) and not any(part[d:] == part[: len(part) - d] for d in range(1, q)):
                out.append((i, len(part), q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted_words(doc_id, text):
    w = SPACE.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def runs(docs):
    out = []
    for d, t in docs:
        w = planted_words(d, t)
        found = periodic_runs(w)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else None
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        lines = "".join("%d,%d,%d\n" % r for r in found)
        out.append((d, len(found), *top, sha(lines), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return sorted(out)


def collocations(docs, least=100, longest=5, share=100, top=2000):
    """docs: (lang, text). Every phrase counted, every longer one looked at."""
    counts, totals = {}, {}
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            totals[lang] = totals.get(lang, 0) + len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    key = lang, tuple(w[i : i + m])
                    counts[key] = counts.get(key, 0) + 1
    candidates = {k: f for k, f in counts.items() if f >= least and len(k[1]) > 1}
    around = {}
    for (lang, w), f in candidates.items():
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                if j - i < len(w):
                    around[lang, w[i:j]] = max(f, around.get((lang, w[i:j]), 0))
    by_lang = {}
    for (lang, w), a in candidates.items():
        if (lang, w) in around and 100 * around[lang, w] >= share * a:
            continue
        n = totals[lang]
        cuts = [(1000 * a * n // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        by_lang.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]], n))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, n, -s) for lang, rows in by_lang.items() for i, (s, a, p, left, right, n) in enumerate(sorted(rows)[:top])
    )


def chats(turns):
    """turns: (conv_id, turn, role, text) -> what the formatted conversation has to give back."""
    by = {}
    for t in sorted(turns, key=lambda t: tuple((x is not None, x) if x is not None else (False,) for x in t)):
        by.setdefault(t[0], []).append((t[2] or "", t[3] or ""))
    out = []
    for conv, rows in by.items():
        learned = "".join(t for r, t in rows if r == "assistant")
        out.append((conv, len(rows), sha("".join(f"{r}\n{t}\n" for r, t in rows)), len(learned), sha(learned)))
    return out


SYMBOLS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}


def encoded_as(hit):
    body = hit.rstrip("=")
    if not re.search("[0-9]", body):
        return None
    if re.fullmatch("[0-9a-f]+|[0-9A-F]+", body):
        return "hex"
    if re.fullmatch("[A-Z2-7]+", body):
        return "base32"
    return "base64" if re.search("[a-z]", body) and re.search("[A-Z]", body) and re.fullmatch("[A-Za-z0-9+/]+|[A-Za-z0-9_-]+", body) else None


def chance(hit, kind):
    """The smallest of the three tests' p-values times three: chi-squared (cube root), runs about the middle, lag one."""
    body = hit.rstrip("=")
    x = [SYMBOLS[kind].index(c) for c in (body.lower() if kind == "hex" else body.replace("-", "+").replace("_", "/"))]
    n, base = len(x), len(SYMBOLS[kind])
    tail = lambda z: math.erfc(z / math.sqrt(2)) / 2
    chi, spread = sum(c * c for c in Counter(x).values()) * base / n - n, 2 / (9 * (base - 1))
    ps = [tail(((chi / (base - 1)) ** (1 / 3) - 1 + spread) / math.sqrt(spread))]
    side = [2 * v >= base for v in x]
    high = sum(side)
    both = 2 * high * (n - high)
    changes = sum(a != b for a, b in zip(side, side[1:]))
    ps.append(2 * tail(abs(changes - both / n) / math.sqrt(max(both * (both - n) / (n * n * (n - 1)), 1e-9))) if both else 0.0)
    mean = sum(x) / n
    square = sum((v - mean) ** 2 for v in x)
    lag = sum((a - mean) * (b - mean) for a, b in zip(x, x[1:]))
    ps.append(2 * tail(abs(lag / square + 1 / n) * math.sqrt(n)) if square else 0.0)
    return min(1.0, 3 * min(ps))


def random_spans(docs):
    """doc_id and the random spans (start, end) that lie in no base span and no longer random one, every pair compared."""
    classes = {"[a-z]": 26, "[A-Z]": 26, "[0-9]": 10, "[+/_=-]": 5}
    seen = {c: sum(len(re.findall(c, t or "")) for _, t in docs) + n for c, n in classes.items()}
    every = sum(seen.values())
    per = {"hex": 4, "base32": 5, "base64": 6}
    found = []
    for row, (d, t) in enumerate(docs):
        spots = set()
        for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", t or ""):
            parts = [m.span()] if encoded_as(m[0]) else [
                (m.start() + p.start(), m.start() + p.end()) for signs in ("+/", "_-", "") for p in re.finditer(f"[A-Za-z0-9{signs}]{{20,}}(?:=+$)?", m[0])]
            spots.update(p for p in parts if encoded_as(t[slice(*p)]))
        for a, b in sorted(spots):
            kind = encoded_as(t[a:b])
            if chance(t[a:b], kind) >= 0.001:
                plain = sum(len(re.findall(c, t[a:b])) * math.log2(seen[c] / every / n) for c, n in classes.items())
                found.append((row, a, b, math.floor(min(-per[kind] * (b - a) - plain, 2000))))
            else:
                found.append((row, a, b, -1))
    least = next((bits for bits in sorted({f[3] for f in found if f[3] >= 0})
                  if 2.0 ** min(bits, 1000) * sum(f[3] >= bits for f in found) >= len(found) / 0.01), 2001)
    out = []
    for row, (d, t) in enumerate(docs):
        base = [tuple(map(int, x.split(":")[1:])) for x in secrets([(d, t)])[0][5].split(",") if x]
        mine = [f[1:3] for f in found if f[0] == row and f[3] >= least]
        inside = lambda s, o: o[0] <= s[0] and s[1] <= o[1]
        out.append((d, [s for s in mine if not any(inside(s, b) for b in base) and not any(inside(s, o) and s != o for o in mine)]))
    return out
