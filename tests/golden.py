"""Plain Python versions of the operators, for small inputs."""

from collections import Counter, deque

import regex


def split(text, pattern):
    if pattern is None:
        return [text] if text else []
    return regex.findall(pattern, text)


def merge(seq, pair, new):
    out, i = [], 0
    while i < len(seq):
        if tuple(seq[i : i + 2]) == pair:
            out.append(new)
            i += 2
        else:
            out.append(seq[i])
            i += 1
    return out


def train(texts, merges, pattern, first_seen=False):
    seqs = [list(c.encode()) for t in texts for c in split(t, pattern)]
    learned = []
    for k in range(merges):
        counts = Counter(p for s in seqs for p in zip(s, s[1:]))
        if not counts:
            break
        most = max(counts.values())
        ties = [p for p, n in counts.items() if n == most]
        pair = ties[0] if first_seen else min(ties)
        learned.append((pair[0], pair[1], 256 + k, most))
        seqs = [merge(s, pair, 256 + k) for s in seqs]
    return learned


def encode(text, learned, pattern):
    ids = []
    for chunk in split(text, pattern):
        seq = list(chunk.encode())
        for a, b, new, *_ in learned:
            seq = merge(seq, (a, b), new)
        ids += seq
    return ids


def pack(groups, rows, cols, rank, world, epochs=1, resume=None):
    """``groups``: (shard, row group, token lists) in reading order. Yields batches with the reader's position."""
    length = rows * cols + 1
    buffer, out = deque(), []
    pulled = []
    for epoch in range(epochs):
        for shard, group, docs in groups:
            if group % world != rank:
                continue
            if epoch == 0 and resume is not None:
                saved_shard, saved_group = resume
                first = (saved_group // world + 1) * world + rank
                if shard < saved_shard or (shard == saved_shard and group < first):
                    continue
            pulled += [(shard, group, d) for d in docs]
    for shard, group, ids in pulled:
        buffer.extend(ids)
        while len(buffer) >= length:
            tokens = [buffer.popleft() for _ in range(length)]
            for r in range(rows):
                low = r * cols
                out.append((rank, len(out) // rows, r, tokens[low : low + cols], tokens[low + 1 : low + cols + 1], shard, group))
    return out
