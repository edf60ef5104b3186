"""Plain versions that several tests compare with."""

from __future__ import annotations

import re

import xxhash


def _lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def mark_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", _lower(text))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups_of(marks):
    """Sets of ids linked over fingerprints that differ in at most four bits."""
    left, groups = dict(marks), []
    while left:
        todo, own = [left.popitem()], set()
        while todo:
            i, mark = todo.pop()
            own.add(i)
            near = [(j, m) for j, m in left.items() if (m ^ mark).bit_count() <= 4]
            for j, _ in near:
                del left[j]
            todo += near
        groups.append(own)
    return groups


def contaminated(text, items, size=13):
    def words_of(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _lower(t))

    words, hit = words_of(text), set()
    for _, item in items:
        own = words_of(item)
        n = min(size, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
    return bool(hit) and 20 * len(hit) >= len(words)
