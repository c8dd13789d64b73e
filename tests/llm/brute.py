"""Plain, quadratic or single-machine versions of the operators, straight from their definitions."""

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def fingerprint(text, size=3):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    size = min(size, len(words))
    hashes = [
        xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42) for i in range(len(words) - size + 1)
    ]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def classes(prints, most=3):
    """Smallest id reachable for every id of ``{id: fingerprint}``."""
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for place, a in enumerate(ids):
        for b in ids[place + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= most:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: find(i) for i in ids}


def _luhn(digits):
    worth = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
    return sum(worth) % 10 == 0


def personal(text):
    """Base spans as (start, rank, end, kind)."""
    text = text or ""
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    out = []
    for rank, (kind, pattern) in enumerate(patterns.items()):
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match[0])
            holds = {
                "email": lambda: True,
                "ip": lambda: all(int(part) <= 255 for part in match[0].split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and _luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if holds:
                out.append((match.start(), rank, match.end(), kind))
    return sorted(out)


def rules(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + step for i, window in enumerate(windows) if counts[window] > 1 for step in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n, repeated = len(words), len(covered)
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated,
        "base_failed": n < 50 or 100 * repeated > 50 * n,
    }


def kept_words(texts, size=20):
    """{id: (words, removed, kept text)}: words in a window that starts earlier are removed."""
    seen, out = set(), {}
    for number in sorted(texts):
        words = WORD.findall(texts[number] or "")
        gone = set()
        for i in range(len(words) - size + 1):
            window = tuple(words[i : i + size])
            if window in seen:
                gone.update(range(i, i + size))
            seen.add(window)
        out[number] = (len(words), len(gone), " ".join(word for i, word in enumerate(words) if i not in gone))
    return out


def kept_bytes(texts, size=200):
    """{id: (bytes, removed, spans, kept)}: bytes in a string that starts anywhere else are removed."""
    data = {number: (text or "").encode() for number, text in texts.items()}
    counts = Counter(raw[i : i + size] for raw in data.values() for i in range(len(raw) - size + 1))
    out = {}
    for number, raw in data.items():
        gone = bytearray(len(raw))
        for i in range(len(raw) - size + 1):
            if counts[raw[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        spans = len(re.findall(b"\1+", bytes(gone)))
        out[number] = (len(raw), sum(gone), spans, bytes(byte for byte, flag in zip(raw, gone) if not flag))
    return out
