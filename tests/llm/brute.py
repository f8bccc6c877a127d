"""Plain answers to compare with."""

import collections
import hashlib
import itertools
import math
import re
import zlib

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def groups(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def near_duplicates(rows):
    """rows: (doc_id, text) with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    links = [
        (a, b) for a in ids for b in ids
        if a < b and sets[a] and sets[b]
        and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    found = groups(ids, links)
    return sorted((i, len(sets[i]), found[i], found[i] == i) for i in ids)


def repeats(rows, length):
    """(doc_id, removed mask) of rows in order."""
    seen, out = set(), []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            window = data[at : at + length]
            if window in seen:
                gone[at : at + length] = b"\1" * length
            seen.add(window)
        out.append((doc_id, data, bytes(gone)))
    return out


def kept_bytes(data, gone):
    return bytes(b for b, g in zip(data, gone, strict=True) if not g)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(text, items, window=10):
    """(words, hit words, item ids)."""
    own = words(text)
    hit, found = set(), set()
    for item_id, item in items:
        theirs = words(item)
        size = min(window, len(theirs))
        for i in range(len(theirs) - size + 1 if theirs else 0):
            for at in range(len(own) - size + 1):
                if own[at : at + size] == theirs[i : i + size]:
                    hit |= set(range(at, at + size))
                    if item_id is not None:
                        found.add(str(item_id))
    return len(own), len(hit), sorted(found)


def in_fold(doc_id, folds, fold):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == fold


class ByteModel:
    """Prediction by partial matching with plain dictionaries."""

    def __init__(self, texts, order):
        self.order = order
        self.tables = [collections.defaultdict(collections.Counter) for _ in range(order + 1)]
        self.words = collections.Counter()
        for text in texts:
            data = self.lowered(text)
            self.words.update(data.split())
            self.words[b"\n"] += 1
            symbols = [256] * order + list(data) + [256]
            for at in range(order, len(symbols)):
                for k in range(order + 1):
                    self.tables[k][tuple(symbols[at - k : at])][symbols[at]] += 1
        self.tokens = sum(self.words.values())

    @staticmethod
    def lowered(text):
        return (text or "").encode().lower()

    def code(self, context, symbol):
        total, excluded = 0.0, set()
        for k in range(self.order, -1, -1):
            counts = self.tables[k].get(context[self.order - k :])
            if counts is None:
                continue
            n = sum(c for s, c in counts.items() if s not in excluded)
            d = sum(1 for s in counts if s not in excluded)
            if symbol in counts:
                return total + math.log10((2 * counts[symbol] - 1) / (2 * n))
            if d:
                total += math.log10(d / (2 * n))
            excluded = set(counts)
        return total - math.log10(257 - len(excluded))

    def score(self, text):
        symbols = [256] * self.order + list(self.lowered(text)) + [256]
        return sum(
            self.code(tuple(symbols[at - self.order : at]), symbols[at])
            for at in range(self.order, len(symbols))
        )

    def base(self, text):
        own = [*self.lowered(text).split(), b"\n"]
        room = self.tokens + 0.5 * (len(self.words) + 1)
        known = sum(w in self.words for w in own)
        return len(own), known, sum(math.log10((self.words[w] + 0.5) / room) for w in own)


def fails(text, repeated):
    """The filters A to E that a text fails, as letters."""
    text = text or ""
    own = re.findall(r"[^\x20\x09-\x0D]+", text)
    return "".join(letter for letter, failed in zip("ABCDE", (
        len(own) < 200, 100 * len(set(own)) < 50 * len(own),
        100 * len(re.findall("[A-Z]", text)) > 3 * len(text), re.search("[#$%&*|]", text),
        repeated,
    ), strict=True) if failed)


def audit(docs, labels):
    """docs: (doc_id, text, lang); labels: (doc_id, quality, toxic). Every order, row by row."""
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, harm in labels if harm == 1 and i is not None}
    parts = collections.defaultdict(list)
    for i, text, lang in docs:
        repeated = i is not None and any(
            j is not None and j < i and (other or "") == (text or "") for j, other, _ in docs
        )
        parts[lang or ""].append((i, fails(text, repeated)))
    found = []
    for part, rows in parts.items():
        own, shapley = [], collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left, gone = list(rows), []
            for step, letter in enumerate(order, start=1):
                out = [r for r in left if letter in r[1]]
                left = [r for r in left if letter not in r[1]]
                shapley[letter] += len(out)
                own.append((
                    letter, part, "".join(order), step, len(left), len(out),
                    sum(letter in r[1] for r in gone), sum(r[1] == letter for r in rows),
                    sum(r[0] in good for r in out), sum(r[0] in toxic for r in out),
                ))
                gone += out
        found += [(*row, shapley[letter]) for letter, *row in own]
    return sorted(found, key=repr)


def trie(rows, group=100, limit=6):
    """rows: (conv_id, turn, role, text); the nodes as `prefix_trie` gives them."""
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, tie, (role, text)))
    own = {c: [t[-1] for t in sorted(turns)] for c, turns in own.items()}
    members = collections.defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % limit
        whole = (*own.get(c - int(math.fmod(c, group)), [])[:h], *turns[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append((c, len(whole)))
    children = collections.Counter(node[:-1] for node in members if node)
    leaves, saved = collections.Counter(), collections.Counter()
    for node, own in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(own) - 1) * len(node[-1][1]) if node else 0
    return sorted((
        (min(own)[0], len(node), min(members[node[:-1]])[0] if node else None, len(own),
         children[node], leaves[node], saved[node], hashlib.sha256(
            ",".join(str(c) for c, n in sorted(own) if n == len(node)).encode()).hexdigest())
        for node, own in members.items()), key=repr)
