"""Plain versions of what the corpus operators compute."""

from __future__ import annotations

import re

import public_tokenizers
from tokenizers import Tokenizer

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, start=0):
    rows = [(start + i, t, "en", "src", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def token_ids(texts, last):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [last] for t in texts]


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, size=5):
    w = re.findall("[^\x20\x09-\x0d]+", ascii_lower(text))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def groups(ids, linked):
    """Smallest id reachable, by repeated passes."""
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def near_groups(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    ids = sorted(sets)
    linked = [
        (a, b) for k, a in enumerate(ids) for b in ids[:k]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    return {i: len(s) for i, s in sets.items()}, groups(ids, linked)


def contamination(text, items, size=13):
    """(n_words, n_hit, item ids) against ``items`` {id: text}."""
    find = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", ascii_lower(t))
    w, hit, ids = find(text), set(), set()
    for item, body in items.items():
        v = find(body)
        for i in range(max(len(v) - size + 1, 1)) if v else ():
            window = v[i : i + size]
            for at in range(len(w) - len(window) + 1):
                if w[at : at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    ids.add(str(item))
    return len(w), len(hit), sorted(ids)
