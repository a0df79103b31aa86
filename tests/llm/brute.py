"""Plain Python versions of what the operators compute, for small tables."""

import hashlib
import re
import zlib
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def shingles(text):
    words = space_words(text)
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near_classes(rows, percent):
    """{doc_id: smallest id reachable over links}."""
    sets = {i: shingles(t) for i, t in rows}
    by_shingle = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by_shingle[x].append(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        for j in {j for x in s for j in by_shingle[x] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}


def cut_lines(text):
    """Lines that are not blank with the blank ones behind them; blank ones at the start are one more."""
    units = []
    for line in text.split("\n"):
        if not units or re.search(r"[^ \t\n\x0B\f\r]", line):
            units.append([line])
        else:
            units[-1].append(line)
    return [(u[0], "\n".join(u)) for u in units]


def line_chunks(lines):
    """(first, last) line of the chunks of several lines between boundaries."""
    hashes = [0] + [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    start = 0
    for i in range(len(lines)):
        if (hashes[i + 1] + 31 * hashes[i] >> 3) % 2 == 0 or i + 1 == len(lines):
            if i > start:
                yield start, i
            start = i + 1


def without_repeats(rows):
    """{doc_id: text} after repeated passages are cut: chunks of several lines, and any run of over 50 words, by comparing all places."""
    cut = {i: cut_lines(text) for i, text in sorted(rows) if text}
    bare = {i: [x for x, _ in units] for i, units in cut.items()}
    gone, seen = {i: set() for i in cut}, {}
    for i, lines in bare.items():
        for a, b in line_chunks(lines):
            if seen.setdefault(tuple(lines[a:b + 1]), (i, a)) != (i, a):
                gone[i].update(range(a, b + 1))
    places = [(i, a) for i, lines in bare.items() for a in range(len(lines))]
    for n, (i, a) in enumerate(places):
        for j, b in places[:n]:
            if a and b and bare[i][a - 1] == bare[j][b - 1]:
                continue
            size = 0
            while a + size < len(bare[i]) and b + size < len(bare[j]) and bare[i][a + size] == bare[j][b + size]:
                size += 1
            run = list(range(a, a + size))
            while run and not bare[i][run[0]].strip():
                run.pop(0)
            if sum(len(re.findall(r"[^ \t\n\x0B\f\r]+", bare[i][k])) for k in run) > 50:
                gone[i].update(run)
    out = {i: text for i, text in rows if not text}
    return out | {i: "\n".join(unit for k, (_, unit) in enumerate(units) if k not in gone[i]) for i, units in cut.items()}


def contamination(text, items):
    """(words hit, items found) of a text; ``items`` as (item_id, text)."""
    words, hit, found = alnum_words(text), set(), set()
    for item_id, item in items:
        item = alnum_words(item)
        if not item:
            continue
        size = min(10, len(item))
        grams = {tuple(item[i:i + size]) for i in range(len(item) - size + 1)}
        for i in range(len(words) - size + 1):
            if tuple(words[i:i + size]) in grams:
                hit |= set(range(i, i + size))
                found.add(str(item_id))
    return len(words), len(hit), sorted(found)


def check_packing(rows, texts, tokenizer, capacity=4096):
    """Pieces against whole encodings; sequences without gap or overlap. Returns (sequences, least possible)."""
    import numpy as np

    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(texts)
    total = 0
    for doc_id, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        total += len(ids)
        own = sorted(pieces[doc_id], key=lambda r: r.piece)
        starts = list(range(0, len(ids), capacity))
        assert [(r.piece, r.start, r.length) for r in own] == [(k, s, len(ids[s:s + capacity])) for k, s in enumerate(starts)]
        assert [r.ids_crc32 for r in own] == [zlib.crc32(np.array(ids[s:s + capacity], "<u4").tobytes()) for s in starts]
    for held in sequences.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences), -(-total // capacity)


def article_text(page):
    """Text of the test pages' article, read with knowledge of how they are made."""
    import html

    body = re.search(r"<article>(.*?)(?:</article>|$)", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*(>|$)", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", body)]
    return " ".join(b for b in blocks if b)
