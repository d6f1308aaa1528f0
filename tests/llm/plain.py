"""Plain statements of the conversation and licence operators, over lists in memory."""

import hashlib
import heapq
import re
import zlib

SPACE = " \t\n\x0b\x0c\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_conversation(rows):
    """``conv: rows`` of ``(conv, turn, role, text)`` in order of turn, nulls first."""
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn, role, text))
    for own in out.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "", r[2] or ""))
    return out


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        if code == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    for own in out.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


def faults(own):
    seen, out = set(), []
    for _, role, text in own:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(own):
    """``(cost, audit)`` by Dijkstra over whole scripts: the least cost, then the least letters."""
    bad, n = faults(own), len(own)
    step = lambda said, x: {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}[said].get(x)
    queue, done = [(0, "", 0, "")], set()
    while queue:
        cost, audit, i, said = heapq.heappop(queue)
        if (i, said) in done:
            continue
        done.add((i, said))
        if i == n and said in ("", "a"):
            return cost, audit
        moves = [("I", 5, i, step(said, x)) for x in "ua"]
        if i < n:
            extra = 5 if bad[i] == "truncated" else 0
            moves.append(("D", 2, i + 1, said))
            if bad[i] not in ("blank", "duplicate"):
                moves += [("R", 1 + extra, i + 1, step(said, x)) for x in "ua"]
                moves.append(("K", extra, i + 1, step(said, own[i][1][:1])))
        for letter, more, j, then in moves:
            if then is not None:
                heapq.heappush(queue, (cost + more, audit + letter, j, then))


def repaired(own, audit):
    out, i, last = [], 0, ""
    for letter in audit:
        role, text = "assistant" if last == "u" else "user", ""
        if letter != "I":
            i += 1
        if letter in "RK":
            text = own[i - 1][2]
        if letter == "K":
            role = own[i - 1][1]
        if letter != "D":
            out.append((letter, role, text))
            last = role[:1]
    return out


def repair(own):
    """The columns of the repair query for damaged rows in order."""
    bad = faults(own)
    turns = [t for t, _, _ in own if t is not None]
    cost, audit = cheapest(own)
    initials = [role[:1] for _, role, _ in own]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        "blank": bad.count("blank"), "duplicate": bad.count("duplicate"), "truncated": bad.count("truncated"),
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), "cost": cost, "audit": audit,
        "repaired_sha256": sha("\n".join(f"{role}:{text}" for _, role, text in repaired(own, audit))),
    }


def rebuilt(rows):
    own = {c: [(r or "", t or "") for _, r, t in x] for c, x in by_conversation(rows).items() if c is not None}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def trie(found):
    """``(conv_id, depth): columns`` of every node."""
    members = {}
    for c, turns in found.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    out = []

    def visit(node):
        leaves, saved = 0, (len(members[node]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for kid in kids.get(node, []):
            more = visit(kid)
            leaves, saved = leaves + more[0], saved + more[1]
        leaves = leaves or 1
        ends = sorted(c for c in members[node] if len(found[c]) == len(node))
        out.append((
            min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(kids.get(node, [])), leaves, saved,
            sha(",".join(map(str, ends))),
        ))
        return leaves, saved

    if members:
        visit(())
    return sorted(out, key=lambda r: (r[1], r[0]))


NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def licence_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def phrases(text, wanted):
    own = licence_words(text)
    out = []
    for phrase, label in wanted.items():
        parts = phrase.split()
        out += [(label, i, i + len(parts)) for i in range(len(own) - len(parts) + 1) if own[i : i + len(parts)] == parts]
    return sorted(out, key=lambda x: (x[1], x[2], x[0]))


def matching(text, templates, run):
    """``(start, end)`` of the runs of ``run`` words or more that some template contains and that cannot grow to the right."""
    own, known = licence_words(text), [licence_words(t) for _, t in templates]
    inside = {tuple(t[i:j]) for t in known for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    out, start = [], 0
    longest = []
    for i in range(len(own)):
        start = min(start, i)
        while start <= i and tuple(own[start : i + 1]) not in inside:
            start += 1
        longest.append(i + 1 - start)
    for i, n in enumerate(longest):
        if n >= run and (i + 1 == len(own) or longest[i + 1] != n + 1):
            out.append((i + 1 - n, i + 1))
    return out
