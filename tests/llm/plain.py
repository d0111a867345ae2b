"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    count = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    seen, lines = set(), 0
    for line in text.split("\n"):
        lines += line in seen and bool(WORD.search(line))
        seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, lines, len(covered)


def shingles(text: str | None, size: int) -> frozenset:
    words = WORD.findall((text or "").translate(_LOWER))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*[words[k:] for k in range(size)], strict=False))


def near_components(rows: list[tuple[int, str | None]], size: int, percent: int) -> dict[int, int]:
    sets = {i: shingles(t, size) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in sets}


def suffix_left(rows: list[tuple[int, str | None]], length: int = 100) -> dict[int, tuple]:
    """Bytes of each text, marks of those to remove, and the remaining bytes."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            piece = data[k : k + length]
            if piece in seen:
                gone[k : k + length] = b"\x01" * length
            seen.add(piece)
        left = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        out[i] = (data, bytes(gone), left)
    return out


def suffix_spans(rows: list[tuple[int, str | None]], length: int = 100) -> dict[int, tuple]:
    return {
        i: (len(data), sum(gone), len(re.findall(b"\x01+", gone)), hashlib.sha256(left).hexdigest())
        for i, (data, gone, left) in suffix_left(rows, length).items()
    }


def leaks(documents: list[tuple[int, str | None]], items: list[str], window: int = 8) -> set[int]:
    def tokens(text: str) -> list[str]:
        found = (re.sub(r"^\W+|\W+$", "", w) for w in WORD.findall(text.lower()))
        return [w for w in found if w]

    known = set()
    for text in items:
        t = tokens(text)
        known |= set(zip(*[t[k:] for k in range(window)], strict=False))
    return {
        i
        for i, text in documents
        if known & set(zip(*[(t := tokens(text or ""))[k:] for k in range(window)], strict=False))
    }


def _turns(rows: list[tuple]) -> dict[int, list[tuple]]:
    """Rows ``conv_id, turn, role, text`` by conversation, in order of turn, nulls first."""
    convs = collections.defaultdict(list)
    for row in rows:
        convs[row[0]].append(row)
    first = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    return {c: sorted(of, key=first) for c, of in convs.items()}


def rebuilt_conversations(rows: list[tuple]) -> dict[int, list[tuple[str, str]]]:
    own = {c: [(r[2] or "", r[3] or "") for r in of] for c, of in _turns(rows).items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))  # as SQL does for ids below 0
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def trie_nodes(convs: dict[int, list[tuple]]) -> list[tuple]:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    members = collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own + sum(saved[k] for k in children[node])
    for node, of in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in of if len(convs[c]) == len(node)))
        out.append(
            (min(of), len(node), min(members[node[:-1]]) if node else None, len(of), len(children[node]),
             leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest())
        )
    return out


def damaged_conversations(rows: list[tuple]) -> dict[int, list[tuple]]:
    out: dict[int, list[tuple]] = {r[0]: [] for r in rows}
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = ":".join(" " if x is None else str(x) for x in (c, turn))
        hurt = zlib.crc32(key.encode()) % 20
        if hurt == 0:
            continue
        text = "" if hurt == 1 else re.sub("[.!?]", "", text) if hurt == 2 else text
        row = (c, turn, "user" if hurt == 4 else role, text)
        out[c] += [row] * (2 if hurt == 3 else 1)
    first = lambda r: (r[1] is not None, r[1] or 0, r[2], r[3])
    return {c: sorted(of, key=first) for c, of in out.items()}


def row_faults(rows: list[tuple[str, str]]) -> list[str]:
    out, seen = [], set()
    for role, text in rows:
        if not WORD.search(text):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if WORD.findall(text)[-1][-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def repaired_conversation(rows: list[tuple[str, str]]) -> tuple[int, str, list[tuple[str, str]]]:
    """Cost, least letters and result, by trying every state forwards and keeping the best way."""
    faults = row_faults(rows)
    best = {"": (0, "", ())}  # by the last role's initial, s only at the start

    def better(ways: dict, state: str, way: tuple) -> None:
        if state not in ways or way[:2] < ways[state][:2]:
            ways[state] = way

    def filled(ways: dict) -> dict:
        for _ in range(4):
            for state, (cost, letters, out) in list(ways.items()):
                to = "a" if state == "u" else "u"
                better(ways, to, (cost + 3, letters + "I", (*out, ({"u": "user", "a": "assistant"}[to], ""))))
        return ways

    for (role, text), wrong in zip(rows, faults, strict=True):
        ways: dict = {}
        for state, (cost, letters, out) in filled(best).items():
            better(ways, state, (cost + 4, letters + "D", out))
            if wrong in ("blank", "duplicate"):
                continue
            more = 3 * (wrong == "truncated")
            if role and state + role[:1] in ("s", "u", "su", "ua", "au"):
                better(ways, role[:1], (cost + more, letters + "K", (*out, (role, text))))
            to = "a" if state == "u" else "u"
            named = {"u": "user", "a": "assistant"}[to]
            better(ways, to, (cost + more + 3, letters + "R", (*out, (named, text))))
        best = ways
    best = filled(best)
    cost, letters, out = min(best[s] for s in ("", "a") if s in best)
    return cost, letters, list(out)


def conversation_reports(rows: list[tuple]) -> dict[int, tuple]:
    """``gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` by id."""
    out = {}
    for c, of in damaged_conversations(rows).items():
        turns = {r[1] for r in of} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        said = [(r[2], r[3]) for r in of]
        faults = row_faults(said)
        pairs = [a[:1] + b[:1] for (a, _), (b, _) in zip(said, said[1:], strict=False)]
        cost, audit, left = repaired_conversation(said)
        text = "\n".join(f"{role}:{text}" for role, text in left)
        out[c] = (
            gaps, *(faults.count(x) for x in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest(),
        )
    return out


# --- Templates of a benchmark, by trying every place --------------------------------

NUMBER, NAME, UNIT = "<num>", "<name>", "<unit>"


def template_tokens(text: str | None, punctuation: str, units: set[str]) -> list[tuple[str, str, bool]]:
    """``word, token, first`` of every word: ``first`` is a capital that may be a name or not."""
    out, ended, number = [], True, False
    for raw in WORD.findall(text or ""):
        core = raw.strip(punctuation)
        if not core:
            continue
        low = core.lower()
        is_number = bool(re.fullmatch(r"[+-]?[0-9][0-9.,:/]*", core))
        capital = core[0].isupper() and core[1:2].islower()
        first = False
        if is_number:
            token = NUMBER
        elif capital and not ended:
            token = NAME
        elif number and low in units:
            token, first = UNIT, capital
        else:
            token, first = low, capital
        out.append((low, token, first))
        ended, number = raw[-1] in ".!?:", is_number
    return out


def _pattern(values: list) -> list[int]:
    return [values.index(v) for v in values]


def _item_windows(tokens: list[tuple], size: int) -> list[tuple]:
    """``at, form, key, as_typed`` in every reading of first words."""
    out = []
    for at in range(len(tokens) - size + 1):
        part = tokens[at : at + size]
        firsts = [k for k, t in enumerate(part) if t[2]]
        for mask in range(1 << len(firsts)):
            named = {k for j, k in enumerate(firsts) if mask >> j & 1}
            form = tuple(NAME if k in named else t[1] for k, t in enumerate(part))
            out.append((at, form, _window_key(form, part), not named))
    return out


def _window_key(form: tuple, part: list[tuple]) -> tuple:
    only_slots = all(t in (NUMBER, NAME, UNIT) for t in form)
    return ("words", *[t[0] for t in part]) if only_slots else form


def template_leaks(documents, items, punctuation: str, units: set[str], limits: dict) -> set[tuple]:
    """``doc_id, item_id`` of every find; ``limits`` are the operator's numbers."""
    window, literal, short, hits_needed, holders = (
        limits[k] for k in ("WINDOW", "MIN_LITERAL", "MIN_SHORT", "MIN_HITS", "MAX_HOLDERS")
    )
    slots = (NUMBER, NAME, UNIT)
    known, alike = {}, set()
    for i, text in sorted((i, t) for i, t in items if i is not None):
        tokens = template_tokens(text, punctuation, units)
        if not tokens:
            continue
        size = min(window, len(tokens))
        starts = range(len(tokens) - size + 1)
        few = any(sum(t[1] not in slots for t in tokens[a : a + size]) < literal for a in starts)
        values = [t[0] for t in tokens if t[1] in slots]
        own = tuple(t[0] for t in tokens) if few or len(tokens) < window else None
        same = (tuple(t[1] for t in tokens), tuple(_pattern(values)), own)
        if same not in alike:
            alike.add(same)
            known[i] = (tokens, size, _item_windows(tokens, size))
    held = collections.defaultdict(set)
    for tokens, _, windows in known.values():
        for _, _, key, _ in windows:
            held[key].add(tuple(t[1] for t in tokens))
    searched = {}
    for i, (tokens, size, windows) in known.items():
        own = [w for w in windows if len(held[w[2]]) <= holders]
        rich = sum(w[3] and sum(t not in slots for t in w[1]) >= literal for w in own)
        typed = sum(w[3] for w in own)
        if typed:
            searched[i] = (tokens, size, own, min(rich or typed, hits_needed))
        else:
            searched[i] = (tokens, size, windows, sum(w[3] for w in windows))
    out = set()
    for doc, text in documents:
        said = template_tokens(text, punctuation, units)
        readings = [(True, [t[1] for t in said]), (False, [NAME if t[2] else t[1] for t in said])]
        sizes = {s for _, s, _, _ in searched.values()}
        places = collections.defaultdict(set)
        for plain_reading, form in readings:
            for size in sizes:
                for at in range(len(said) - size + 1):
                    key = _window_key(tuple(form[at : at + size]), said[at : at + size])
                    places[size, key].add((at, plain_reading))
        for i, (tokens, size, windows, needed) in searched.items():
            at_shift = collections.defaultdict(lambda: (set(), set(), set()))
            for at, form, key, as_typed in windows:
                for place, plain_reading in places.get((size, key), ()):
                    hit, sure, typed = at_shift[place - at]
                    hit.add(at)
                    if not any(t in slots for t in form):
                        sure.add(at)
                    if as_typed and plain_reading:
                        typed.add(at)
            for shift, (hit, sure, typed) in at_shift.items():
                if len(hit) < needed:
                    continue
                if len(sure) >= needed:
                    out.add((doc, i))
                    continue
                least = min(len(tokens), short) if len(tokens) < window else literal
                for found, kinds in ((hit, lambda t: t[1] in slots or t[2]), (typed, lambda t: t[1] in slots)):
                    inside = {p for a in found for p in range(a, a + size)}
                    same = sum(said[p + shift][0] == tokens[p][0] for p in inside)
                    asked = [p for p in sorted(inside) if kinds(tokens[p])]
                    ours = _pattern([tokens[p][0] for p in asked])
                    theirs = _pattern([said[p + shift][0] for p in asked])
                    if len(found) >= needed and same >= least and ours == theirs:
                        out.add((doc, i))
    return out


def minimal_url_rules(baskets: list[tuple[set[str], bool]], support: float, confidence: float) -> set[tuple]:
    """All sets of tokens that mean "blocked" often enough, by trying each subset of each
    labelled URL's tokens; of these, those that hold no other."""
    held: dict[frozenset, list[int]] = {}
    for tokens, blocked in baskets:
        for size in range(1, len(tokens) + 1):
            for part in combinations(sorted(tokens), size):
                seen = held.setdefault(frozenset(part), [0, 0])
                seen[0] += 1
                seen[1] += blocked
    least = math.ceil(support * len(baskets))
    rules = {part for part, (n, bad) in held.items() if bad >= max(least, 1) and bad / n >= confidence}
    return {tuple(sorted(r)) for r in rules if not any(other < r for other in rules)}
