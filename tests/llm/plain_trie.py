"""The trie of rebuilt conversations, prefix by prefix."""

import hashlib
import zlib
from collections import defaultdict


def plain_trie(rows):
    """``{(conv_id, depth): (parent, n_convs, n_children, n_leaves, saved, ends)}`` of ``(conv, turn, role, text)`` without ties."""
    turns = defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if c is not None:
            turns[c].append((role or "", text or ""))
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = turns.get(c - c % 5, [])[:h] + turns[c][h:]
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    kids = defaultdict(list)
    for seq in members:
        if seq:
            kids[seq[:-1]].append(seq)
    sums = {}
    for seq in sorted(members, key=len, reverse=True):
        own = (len(members[seq]) - 1) * len(seq[-1][1].encode()) if seq else 0
        below = [sums[k] for k in kids[seq]]
        sums[seq] = (sum(x[0] for x in below) if below else 1, own + sum(x[1] for x in below))
    out = {}
    for seq, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(built[c]) == len(seq))
        parent = min(members[seq[:-1]]) if seq else None
        out[min(cs), len(seq)] = (parent, len(cs), len(kids[seq]), *sums[seq], hashlib.sha256(ends.encode()).hexdigest())
    return out
