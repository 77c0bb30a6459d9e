"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def repeats(docs, width=50):
    """doc (id, text) list -> list of (id, n_bytes, n_removed, n_spans, sha of the rest)."""
    least = {}
    for i, text in docs:
        b = (text or "").encode()
        for p in range(len(b) - width + 1):
            if i is not None:
                least[b[p:p + width]] = min(i, least.get(b[p:p + width], i))
    out = []
    for i, text in docs:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - width + 1):
            if i is not None and least[b[p:p + width]] < i:
                gone[p:p + width] = b"\1" * width
        spans = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, sha(bytes(c for c, g in zip(b, gone) if not g))))
    return out


def simhash(text):
    import xxhash
    words = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64)
               if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def components(docs, distance=3):
    """doc (id, text) list -> list of (id, fingerprint, smallest reachable id)."""
    fps = [simhash(t) for _, t in docs]
    group = list(range(len(docs)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x
    for a in range(len(docs)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                group[y] = x
    least = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [(i, f"{fps[k]:016x}", least.get(find(k))) for k, (i, _) in enumerate(docs)]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def benchmark_hits(docs, items, window=10):
    """-> list of (id, n_words, n_hit, n_items, items sha)."""
    windows = []
    for item, text in items:
        w = WORD.findall(lower_ascii(text))
        if item is not None and w:
            windows += [(str(item), w[p:p + window]) for p in range(max(1, len(w) - window + 1))]
    out = []
    for i, text in docs:
        w = WORD.findall(lower_ascii(text))
        hit, found = set(), set()
        for item, x in windows:
            for p in range(len(w) - len(x) + 1):
                if w[p:p + len(x)] == x:
                    hit.update(range(p, p + len(x)))
                    found.add(item)
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found)))))
    return out


def luhn(digits):
    rest = [int(c) for c in digits[::-1]]
    return (sum(rest[0::2]) + sum(sum(divmod(2 * d, 10)) for d in rest[1::2])) % 10 == 0


def personal(text):
    """Base spans: 'kind:start:end' strings in the contract's order."""
    text = text or ""
    out = [f"email:{m.start()}:{m.end()}" for m in re.finditer(
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [f"ip:{m.start()}:{m.end()}" for m in re.finditer(
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
        if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(f"card:{m.start()}:{m.end()}")
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(f"phone:{m.start()}:{m.end()}")
    return out
