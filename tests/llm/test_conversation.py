"""Conversation repair against a plain dynamic programme over audit strings."""
import hashlib
import random
import zlib

import pytest

from ledgerlens.llm import conversation

WS = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def plain_damage(rows):
    out = []
    for c, t, role, text in rows:
        role, text = (" " if role is None else role), (" " if text is None else text)
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (c, t)).encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(x for x in text if x not in ".!?")
        if kind == 4:
            role = "user"
        out += [(c, t, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain_repair(rows):
    """rows of one conversation in order -> (counts, cost, audit, repaired lines)"""
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.strip(WS)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    turns = [t for _, t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    after = {"": "su", "s": "u", "u": "a", "a": "u"}

    def inserted(best):
        for _ in range(2):
            for q, (c, a, o) in list(best.items()):
                to = "a" if q == "u" else "u"
                new = (c + 5, a + "I", o + [("user" if to == "u" else "assistant") + ":"])
                if to not in best or new[:2] < best[to][:2]:
                    best[to] = new
        return best

    best = {"": (0, "", [])}
    for (_, _, role, text), fault in zip(rows, faults):
        then = {}

        def offer(q, new):
            if q not in then or new[:2] < then[q][:2]:
                then[q] = new

        for q, (c, a, o) in inserted(best).items():
            offer(q, (c + 2, a + "D", o))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            if role[:1] in ("s", "u", "a") and role[:1] in after[q]:
                offer(role[:1], (c + more, a + "K", o + [f"{role}:{text}"]))
            to = "a" if q == "u" else "u"
            offer(to, (c + 1 + more, a + "R", o + [("user" if to == "u" else "assistant") + f":{text}"]))
        best = then
    ends = [v for q, v in inserted(best).items() if q in ("", "a")]
    cost, audit, lines = min(ends, key=lambda v: v[:2])
    return [gaps] + [faults.count(k) for k in ("blank", "duplicate", "truncated")] + [illegal, cost, audit], lines


def plain(rows):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    out = {}
    for c, own in by.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0))
        counts, lines = plain_repair(own)
        out[c] = (*counts, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def ours(spark, rows, schema=SCHEMA):
    fixed = conversation.repair(spark.createDataFrame(rows, schema))
    found = conversation.joined(fixed.summary, conversation.digests(fixed.rows), ["conv_id"], "left").collect()
    empty = hashlib.sha256().hexdigest()
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256 or empty) for r in found}


def made(seed, convs, most, roles=("user", "assistant", "system")):
    g = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(g.randint(1, most)):
            if g.random() < 0.9:
                rows.append((c, t, g.choice(roles), g.choice(["Yes.", "no", "", " \n", "Well!", f"word {g.randint(0, 30)}.", f"part {g.randint(0, 30)}"])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_programme(spark, seed):
    rows = made(seed, 150, 12, ("user", "assistant", "system", "tool", "agent"))
    assert ours(spark, rows) == plain(rows)


def test_long_conversations_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(conversation, "PIECE", 7)
    rows = made(3, 6, 150)
    assert ours(spark, rows) == plain(rows)


def test_graph_ranks_follow_audits():
    """Ranks of whole audits order the nodes as the audits themselves do."""
    import numpy as np
    g = random.Random(5)
    n = 40
    initial = np.array([g.randint(0, 3) for _ in range(n)])
    forced = np.array([g.random() < 0.2 for _ in range(n)])
    cut = np.array([g.random() < 0.3 for _ in range(n)]).astype(int)
    made_ = conversation.graph(initial, forced, cut, np.ones(n, int), np.array([15, 25]), np.tile(conversation.ENDING, (2, 1)))
    audits = {}
    for v in range(len(made_.letter) - 1):
        at, text = v, ""
        while made_.letter[at]:
            text += conversation.LETTERS[made_.letter[at] - 1]
            at = made_.jumps[0][at]
        audits[v] = text
        assert len(text) == made_.length[v]
    for a in range(0, len(audits), 3):
        for b in range(0, len(audits), 5):
            assert (made_.rank[a] < made_.rank[b]) == (audits[a] < audits[b])


def test_nulls_ties_copies_and_extra_columns(spark):
    rows = [(1, None, "user", "First?"), (1, 0, "user", "First?"), (1, 0, None, "x."), (1, 1, "assistant", "Good."),
            (None, 3, "system", "Be kind."), (None, 4, "user", "Hm."), (None, 4, "user", "Hm."), (None, None, None, None),
            (2, 5, "assistant", None), (3, 0, "user", "Same."), (3, 0, "user", "Same."), (3, 0, "user", "Same."), (3, 1, "assistant", "end " * 5000)]
    want = plain([tuple(" " if i > 1 and x is None else x for i, x in enumerate(r)) for r in sorted(rows, key=lambda r: (r[2] or " ", r[3] or ""))])
    assert ours(spark, rows) == want
    wide = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", part int, piece int")
    fixed = conversation.repair(wide)
    assert fixed.summary.count() == 4
    assert {r.edit for r in fixed.rows.collect()} <= {"K", "R", "I"}
    text_ids = [(str(r[0]), *r[1:]) for r in rows if r[0] is not None]
    assert {int(k): v for k, v in ours(spark, text_ids, SCHEMA.replace("conv_id long", "conv_id string")).items()} == {k: v for k, v in want.items() if k is not None}


def test_empty_table(spark):
    assert ours(spark, []) == {}


def test_hot_copies_travel_as_counts(spark):
    rows = [(7, 0, "user", "Hi.")] * 3000 + [(7, 1, "assistant", "Yes.")]
    got = ours(spark, rows)[7]
    assert got[:6] == (0, 0, 2999, 0, 2999, 2 * 2999) and got[6] == "K" + "D" * 2999 + "K"


def test_damage(spark):
    rows = [(c, t, r, x) for c in range(40) for t, r, x in [(0, "system", "Be! kind."), (1, "user", "a? b."), (None, "assistant", "c."), (2, None, None)]]
    got = conversation.damaged(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain_damage(rows)))
    assert any(r.text == "" for r in got)
