"""The operators' results by plain Python over small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def substring_dedup(rows, width=35):
    """rows: (doc_id, text); a list of (doc_id, n_words, n_removed, kept_sha256)."""
    words = [BLANK.findall(text or "") for _, text in rows]
    seen = Counter(tuple(own[i : i + width]) for own in words for i in range(len(own) - width + 1))
    out = []
    for (doc_id, _), own in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(own) - width + 1):
            if seen[tuple(own[i : i + width])] > 1:
                gone.update(range(i, i + width))
        kept = " ".join(word for i, word in enumerate(own) if i not in gone)
        out.append((doc_id, len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def decontaminate(rows, items, width=10):
    windows = defaultdict(set)
    for item, text in items:
        own = ALNUM.findall((text or "").translate(UP))
        for i in range(max(1, len(own) - width + 1) if own else 0):
            windows[tuple(own[i : i + width])].add(item)
    sizes = {len(x) for x in windows}
    out = []
    for doc_id, text in rows:
        own = ALNUM.findall((text or "").translate(UP))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(own) - size + 1):
                if (key := tuple(own[i : i + size])) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[key]
        ids = sorted(str(x) for x in found if x is not None)
        out.append((doc_id, len(own), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


def check_packing(rows, packed, tokenizer, capacity=2048):
    """Every document's pieces are there, right, and gapless in their sequences; the number of sequences."""
    wanted = Counter()
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for n, at in enumerate(range(0, len(ids), capacity)):
            own = ids[at : at + capacity]
            wanted[doc_id, n, at, len(own), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in own))] += 1
    assert wanted == Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed)
    by = defaultdict(list)
    for r in packed:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def shingles(text, width=5):
    own = BLANK.findall(text or "")
    return frozenset(tuple(own[i : i + width]) for i in range(max(1, len(own) - width + 1))) if own else frozenset()


def jaccard_join(rows, least=0.8):
    """{row number: (row numbers of its class, number of linked rows)}."""
    sets = [shingles(text) for _, text in rows]
    links = defaultdict(set)
    by = defaultdict(list)
    for i, own in enumerate(sets):
        near = Counter(j for x in own for j in by[x])
        for j, n in near.items():
            if n >= least * (len(own) + len(sets[j]) - n):
                links[i].add(j)
                links[j].add(i)
        for x in own:
            by[x].append(i)
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, own in links.items():
        for j in own:
            a, b = top(i), top(j)
            root[max(a, b)] = min(a, b)
    return [(top(i), len(links[i])) for i in range(len(rows))]


def quality(text):
    body = text or ""
    own = BLANK.findall(body)
    windows = [tuple(own[i : i + 3]) for i in range(len(own) - 2)]
    seen = Counter(windows)
    gone = {i + j for i, x in enumerate(windows) if seen[x] > 1 for j in range(3)}
    lines = [x for x in body.split("\n") if BLANK.search(x)]
    return len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in body), len(lines) - len(set(lines)), len(gone)
