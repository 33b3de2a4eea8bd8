"""Plain restatements of the operators for small inputs."""

import hashlib
import math
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def suffix_dedup(docs, size=100):
    """docs: (doc_id, text) with distinct ids."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - size + 1):
            piece = data[i : i + size]
            if piece in seen:
                gone[i : i + size] = b"\x01" * size
            else:
                seen.add(piece)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out[doc_id] = (len(data), sum(gone), spans, sha(kept))
    return out


def window_dedup(docs, size=35):
    found, words = {}, {}
    for doc_id, text in docs:
        words[doc_id] = w = WORD.findall(text or "")
        for i in range(len(w) - size + 1):
            found.setdefault(tuple(w[i : i + size]), []).append((doc_id, i))
    out = {}
    gone = {d: bytearray(len(w)) for d, w in words.items()}
    for places in found.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i : i + size] = b"\x01" * size
    for d, w in words.items():
        kept = " ".join(x for x, g in zip(w, gone[d]) if not g)
        out[d] = (len(w), sum(gone[d]), sha(kept.encode()))
    return out


def shingles(text, n=5):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def near_duplicates(docs, percent=85):
    sets = {d: shingles(t) for d, t in docs}
    top = {d: d for d in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    ra, rb = find(a), find(b)
                    top[max(ra, rb)] = min(ra, rb)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def base_statistics(text):
    text = text or ""
    words = WORD.findall(text)
    grams = {}
    for i in range(len(words) - 2):
        grams.setdefault(tuple(words[i : i + 3]), []).append(i)
    twice = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(twice) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(twice), failed)


BYTE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def byte_words(text):
    return BYTE_WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def features(text):
    words = byte_words(text)
    return [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def importance(docs, target, buckets=10_000, percent=5):
    """docs: (doc_id, text) with distinct ids; target: texts."""
    own, aim = [0] * buckets, [0] * buckets
    for counts, texts in ((own, [t for _, t in docs]), (aim, target)):
        for text in texts:
            for f in features(text):
                counts[zlib.crc32(f.encode()) % buckets] += 1
    gain = [
        math.floor(1000 * math.log((t + 1.0) * (sum(own) + float(buckets)) / ((s + 1.0) * (sum(aim) + float(buckets)))))
        for s, t in zip(own, aim)
    ]
    out = {}
    for doc_id, text in docs:
        found = [zlib.crc32(f.encode()) % buckets for f in features(text)]
        h = int(sha(f"42:{doc_id}".encode())[:8], 16)
        weight = sum(gain[b] for b in found)
        out[doc_id] = (len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))))
    can = sorted((-out[d][2], d) for d, t in docs if len(byte_words(t)) >= 20)
    rank = {d: i + 1 for i, (_, d) in enumerate(can[: percent * len(can) // 100])}
    return {d: (*x, rank.get(d)) for d, x in out.items()}


def decontaminate(docs, items, size=10):
    """docs: (doc_id, text) with distinct ids; items: (item_id, text)."""
    windows = {}
    for item, text in items:
        w = byte_words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    out = {}
    for doc_id, text in docs:
        w, hit, names = byte_words(text), set(), set()
        for n in range(1, size + 1):
            for i in range(len(w) - n + 1):
                found = windows.get(tuple(w[i : i + n]))
                if found:
                    hit.update(range(i, i + n))
                    names |= found
        out[doc_id] = (len(w), len(hit), len(names), sha(",".join(sorted(names, key=str.encode)).encode()), bool(hit))
    return out


def repaired(rows):
    """rows: (turn, role, text) of one conversation; everything but gaps is found by trying all edits."""
    rows = sorted(
        ((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
        key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()),
    )
    faults, seen = [], set()
    for _, role, text in rows:
        shown = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    allowed = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {}

    def ways(i, said):
        """Least (cost, edits) of all ways to end from here, with the lines they leave."""
        if (i, said) not in best:
            found = [(0, "", ())] if i == len(rows) and said in ("", "a") else []
            for n in range(1, 3):  # rows put in before the next row is dealt with
                state, new = said, []
                for _ in range(n):
                    state = "a" if state == "u" else "u"
                    new.append((state, ""))
                found += [(c + 5 * n, "I" * n + e, (*new, *x)) for c, e, x in steps(i, state)]
            best[i, said] = min(found + steps(i, said), key=lambda w: w[:2])
        return best[i, said]

    def steps(i, said):
        if i == len(rows):
            return [(0, "", ())] if said in ("", "a") else []
        c, e, x = ways(i + 1, said)
        out = [(c + 2, "D" + e, x)]
        if faults[i] not in ("blank", "duplicate"):
            pay, role = 5 * (faults[i] == "truncated"), rows[i][1]
            for edit, name in (("K", role), ("R", "user"), ("R", "assistant")):
                if name[:1] and name[:1] in allowed[said]:
                    c, e, x = ways(i + 1, name[0])
                    out.append((c + pay + (edit == "R"), edit + e, ((name, rows[i][2]), *x)))
        return out

    for i in range(len(rows), -1, -1):
        for said in allowed:
            ways(i, said)
    cost, edits, lines = ways(0, "")
    names = {"u": "user", "a": "assistant"}
    text = "\n".join(f"{names.get(role, role)}:{said}" for role, said in lines)
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[1][:1] for r in rows]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost,
        "audit": edits,
        "repaired_sha256": sha(text.encode()),
    }


def damaged(rows):
    """rows: (conv_id, turn, role, text)."""
    out = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        text, role = " " if text is None else text, " " if role is None else role
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out
