"""Plain versions of the operators, for small inputs."""

import hashlib
import re
import zlib
from collections import defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes(range(256)).replace(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text, size):
    words = [w.translate(LOWER) for w in WORD.findall((text or "").encode())]
    if 0 < len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def jaccard_components(rows, size, percent):
    """Set size and component by id, for unique ids."""
    sets = {doc: shingles(text, size) for doc, text in rows}
    holders, shared = defaultdict(list), defaultdict(int)
    for doc, found in sets.items():
        for shingle in found:
            holders[shingle].append(doc)
    for docs in holders.values():
        for i, b in enumerate(docs):
            for a in docs[:i]:
                shared[a, b] += 1
    parent = {doc: doc for doc in sets}

    def root(doc):
        while parent[doc] != doc:
            doc = parent[doc]
        return doc

    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {doc: (len(sets[doc]), root(doc)) for doc in sets}


def without_repeated_words(rows, window):
    """Number of words, number removed and the text kept, by id."""
    words = {doc: WORD.findall((text or "").encode()) for doc, text in rows}
    first = {}
    for doc in sorted(words):
        for i in range(len(words[doc]) - window + 1):
            first.setdefault(tuple(words[doc][i : i + window]), doc)
    out = {}
    for doc, found in words.items():
        gone = set()
        for i in range(len(found) - window + 1):
            if first[tuple(found[i : i + window])] < doc:
                gone.update(range(i, i + window))
        out[doc] = len(found), len(gone), b" ".join(w for i, w in enumerate(found) if i not in gone).decode()
    return out


def without_repeated_bytes(rows, window):
    """Number of bytes, number removed, runs removed and the bytes kept, by id."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - window + 1):
            part = data[i : i + window]
            if part in seen:
                gone[i : i + window] = b"\1" * window
            seen.add(part)
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out[doc] = len(data), sum(gone), runs, bytes(b for b, g in zip(data, gone, strict=True) if not g)
    return out


def sha(data):
    return hashlib.sha256(data).hexdigest()


def edit_distance_within(item, text):
    """The smallest edit distance of an item to a substring of a text."""
    above = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        row = [i]
        for j, d in enumerate(text, 1):
            row.append(min(row[-1] + 1, above[j] + 1, above[j - 1] + (c != d)))
        above = row
    return min(above)


def greedy_pieces(word, pieces, longest):
    """Number of pieces of the longest-match split, 1 if there is none."""
    at = n = 0
    while at < len(word):
        size = next((s for s in range(min(longest, len(word) - at), 0, -1) if word[at : at + s] in pieces), 0)
        if not size:
            return 1
        at, n = at + size, n + 1
    return n


def best_split(word, scores, unknown):
    """Pieces of the best-scoring split; of equal ones the longest last piece wins at each position."""
    best = [(0.0, 0, None)]
    for end in range(1, len(word) + 1):
        options = []
        for begin in range(end):
            piece = word[begin:end]
            if piece in scores:
                options.append((best[begin][0] + scores[piece], begin, piece))
            elif end - begin == 1:
                options.append((best[begin][0] + unknown, begin, None))
        best.append(max(options, key=lambda option: option[0]))
    out, end = [], len(word)
    while end:
        _, begin, piece = best[end]
        out.append(piece if piece is not None else word[begin:end].encode())
        end = begin
    return out[::-1]


def rebuilt_conversations(rows):
    """Turns (role, text) by conv_id: the first h of conversation c - c % 5, then the own ones after h."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append(((turn is not None, turn or 0), role or "", hashlib.md5((text or "").encode()).digest(), text or ""))
    own = {conv: [(role, text) for _, role, _, text in sorted(found)] for conv, found in turns.items()}
    out = {}
    for conv in own:
        h, base = zlib.crc32(str(conv).encode()) % 9, conv - (conv % 5 if conv >= 0 else -(-conv % 5))
        out[conv] = own.get(base, [])[:h] + own[conv][h:]
    return out


def trie(rebuilt):
    """Rows of the trie: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    members = defaultdict(list)
    for conv, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[child] for child in below) if below else 1
        mine = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = mine + sum(saved[child] for child in below)
    out = []
    for node, convs in members.items():
        ends = sorted(conv for conv in convs if len(rebuilt[conv]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children[node]), leaves[node], saved[node], sha(",".join(map(str, ends)).encode())))
    return sorted(out, key=str)


def damaged_rows(rows):
    """Rows after damage by conv_id, in order; a conversation that lost all has an empty list."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        shown = [" " if v is None else str(v) for v in (conv, turn)]
        fate = zlib.crc32(":".join(shown).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        out[conv] += [((turn is not None, turn or 0), role, hashlib.md5(text.encode()).digest(), text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return {conv: [(turn if known else None, role, text) for (known, turn), role, _, text in sorted(found)] for conv, found in out.items()}


def role_faults(turns):
    """For each turn whether it is blank, duplicate, truncated or None."""
    seen, out = set(), []
    for _, role, text in turns:
        said = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest_repair(turns, most=4):
    """Cost, audit and text of the best repair, trying every edit with up to ``most`` insertions in a row."""
    faults = role_faults(turns)
    names = {"u": "user", "a": "assistant"}
    # All that matters of what was said: the initials so far, as far as the grammar tells them apart.
    state = {"": (0, "", ())}
    grammar = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def better(found, key, option):
        if key not in found or option[:2] < found[key][:2]:
            found[key] = option

    def with_insertions(state):
        found = dict(state)
        for _ in range(most):
            for key, (cost, audit, lines) in list(found.items()):
                for initial, name in names.items():
                    if (after := grammar.get((key, initial))) is not None:
                        better(found, after, (cost + 3, audit + "I", (*lines, name + ":")))
        return found

    for (_, role, text), fault in zip(turns, faults):
        found = {}
        for key, (cost, audit, lines) in with_insertions(state).items():
            better(found, key, (cost + 4, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                price = 3 * (fault == "truncated")
                if (after := grammar.get((key, role[:1]))) is not None:
                    better(found, after, (cost + price, audit + "K", (*lines, f"{role}:{text}")))
                for initial, name in names.items():
                    if (after := grammar.get((key, initial))) is not None:
                        better(found, after, (cost + price + 3, audit + "R", (*lines, f"{name}:{text}")))
        state = found
    found = with_insertions(state)
    return min(found[key] for key in ("", "a") if key in found)


def repair_report(rows):
    """Rows of the repair: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    out = []
    for conv, turns in damaged_rows(rows).items():
        faults = role_faults(turns)
        numbers = {turn for turn, _, _ in turns if turn is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        initials = [role[:1] for _, role, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = cheapest_repair(turns)
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(lines).encode())))
    return sorted(out, key=str)


ADDRESS = r"(?P<email>[\w.+%-]{0,63}\w@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,})|"


def personal_values(text, low=0, high=None):
    """Kind, begin and end of each value, by one search after the other over the whole rest of the text."""
    from corpusloom.llm.pseudonyms import CARD_SHAPES, PATTERN

    high = len(text) if high is None else high
    plain = re.compile(ADDRESS + PATTERN.pattern)
    while match := plain.search(text, low, high):
        begin, end = match.span()
        if match.lastgroup == "number":
            run = re.compile(r"[0-9](?:[ -]?[0-9])*").match(text, begin, high)
            groups = [m.span() for m in re.compile("[0-9]+").finditer(text, begin, run.end())]
            if run.end() < high and re.match(r"\w", text[run.end()]):
                groups.pop()

            def valid(some):
                digits = [int(c) for a, b in some for c in text[a:b]]
                return 13 <= len(digits) <= 19 and sum(sum(divmod(d * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0

            runs = [(first, last) for first in range(len(groups)) for last in range(len(groups), first, -1) if valid(groups[first:last])]
            if runs:
                first, last = runs[0]
                usual = [(a, b) for a in range(first, last) for b in range(a + 1, len(groups) + 1) if b - a <= 5 and valid(groups[a:b])]
                usual = [(a, b) for a, b in usual if b - a == 1 or tuple(y - x for x, y in groups[a:b]) in CARD_SHAPES]
                first, last = usual[0] if usual else runs[0]
                yield from personal_values(text, begin, groups[first][0])
                begin, end = groups[first][0], groups[last - 1][1]
        yield match.lastgroup, begin, end
        low = end
