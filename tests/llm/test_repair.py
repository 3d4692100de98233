"""Conversation repair against trying all edits, and the query against a plain version."""

import hashlib
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings, strategies as st

from tallyfold.llm import repair
from tallyfold.llm.repair import Costs, Editor, cheapest

SF = "/root/testdata/sf0.01"
LEGAL = re.compile(r"(s?(ua)+)?")


def tried(rows, costs, most):
    """Least (cost, audit) of all edits with up to ``most`` inserts."""
    best = None

    def go(i, inserts, audit, cost, roles):
        nonlocal best
        if best and cost > best[0]:
            return
        if i == len(rows) and LEGAL.fullmatch(roles) and (best is None or (cost, audit) < best):
            best = (cost, audit)
        if inserts < most:
            for role in "ua":
                go(i, inserts + 1, audit + "I", cost + costs.insert, roles + role)
        if i < len(rows):
            initial, fault = rows[i]
            go(i + 1, inserts, audit + "D", cost + costs.delete, roles)
            if fault not in (1, 2):
                more = costs.truncated if fault == 3 else 0
                if initial in ("s", "u", "a"):
                    go(i + 1, inserts, audit + "K", cost + costs.keep + more, roles + initial)
                for role in "ua":
                    go(i + 1, inserts, audit + "R", cost + costs.rerole + more, roles + role)

    go(0, 0, "", 0, "")
    return best


ROW = st.tuples(st.sampled_from(["s", "u", "a", ""]), st.sampled_from([0, 0, 0, 1, 2, 3]))


@settings(max_examples=150, deadline=None)
@given(st.lists(ROW, max_size=6))
def test_cheapest_of_all_edits(rows):
    assert cheapest(rows) == tried(rows, Costs(), 2)


@settings(max_examples=80, deadline=None)
@given(st.lists(ROW, max_size=4), st.sampled_from([Costs(insert=1, delete=2), Costs(insert=2, delete=2, rerole=3), Costs(0, 2, 3, 1, 0)]))
def test_cheap_inserts(rows, costs):
    assert cheapest(rows, costs) == tried(rows, costs, len(rows) + 1)


@settings(max_examples=60, deadline=None)
@given(st.lists(ROW, max_size=60), st.integers(1, 9))
def test_blocks_give_what_one_piece_gives(rows, block):
    want = cheapest(rows) if len(rows) <= repair.BLOCK else None
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(repair, "BLOCK", block)
        assert cheapest(rows) == want


def test_long_conversation():
    rows = [("s", 0)] + [("ua"[i % 2], 0) for i in range(100_000)] + [("u", 3), ("a", 1)]
    cost, audit = cheapest(rows)
    assert (cost, audit) == (4, "K" * 100_001 + "DD")


def plain(rows, conversations):
    """The contract row by row. ``rows``: (conv_id, turn, role, text)."""
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        by_conv[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv in conversations:
        live = sorted(by_conv[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        faults, coded, seen = [0, 0, 0, 0], [], set()
        for _, role, text in live:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = 1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0
            seen.add((role, text))
            faults[fault] += 1
            coded.append((role[:1] if role[:1] in ("s", "u", "a") else "", fault))
        turns = [t for t, _, _ in live if t is not None]
        initials = [r[1][:1] for r in live]
        cost, audit = tried(coded, Costs(), 1) if len(coded) <= 7 else cheapest(coded)
        lines, roles, at = [], "", 0
        for letter in audit:
            if letter == "I":
                roles += "a" if roles.endswith("u") else "u"
                lines.append(repair.NAMES[roles[-1]] + ":")
                continue
            _, role, text = live[at]
            at += 1
            if letter != "D":
                roles += role[0] if letter == "K" else "a" if roles.endswith("u") else "u"
                lines.append((role if letter == "K" else repair.NAMES[roles[-1]]) + ":" + text)
        assert LEGAL.fullmatch(roles)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out[conv] = (gaps, *faults[1:], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def compared(df, columns=("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[c] for c in columns) for r in rows}


def test_query_on_the_whole_table(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = compared(repair.report(table))
    assert got == plain(rows, {r[0] for r in rows}) and any(r[5] for r in got.values())


def edge_rows():
    rows = [(i, t, ("user", "assistant", "system", "tool", "", None, "ünknown")[(i * 7 + t * 3) % 7],
             ("Yes.", None, "", " \n\t", "no end", "Same.", "Same.", "é!", "x\x1c", "\x85.", "a" * 100_000 + ".")[(i + t * t) % 11])
            for i in range(60) for t in range(6)]
    rows += [(i, None, "user", "No turn.") for i in range(10)] + [(None, t, "user", f"{t}.") for t in range(9)]
    rows += [(None, None, None, None), (100, -5, "user", "Far."), (100, 10**15, "assistant", "Away."), (100, -(1 << 63), "user", "Least."),
             (100, (1 << 63) - 1, "user", "Most.")]
    return rows + rows[:25] + [(7, 3, "user", "Tie A."), (7, 3, "assistant", "Tie B."), (7, 3, "user", "Tie C.")]


def test_edge_rows(spark):
    rows = edge_rows()
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, plan string, kind int")
    want = {k: (min(v[0], (1 << 63) - 1), *v[1:]) for k, v in plain(rows, {r[0] for r in rows}).items()}
    assert compared(repair.report(df.repartition(5))) == want


def test_conversation_without_rows(spark):
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(dropped, 0, "user", "Gone.")], "conv_id bigint, turn bigint, role string, text string")
    assert compared(repair.report(df)) == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert repair.report(df.where("false")).collect() == []


def test_repaired_rows(spark):
    rows = [("c", 0, "system", "Be kind."), ("c", 1, "assistant", "Hi."), ("c", 2, "assistant", "Hello."), ("c", 3, "user", "  "),
            ("d", 0, "user", "Alone."), ("e", 0, "user", "One?"), ("e", 1, "user", "Two?")]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    got = [tuple(r) for r in repair.repaired(df).orderBy("conv_id", "position").collect()]
    assert got == [("c", 0, "system", "Be kind.", "K"), ("c", 1, "user", "Hi.", "R"), ("c", 2, "assistant", "Hello.", "K"),
                   ("e", 0, "user", "One?", "K"), ("e", 1, "assistant", "Two?", "R")]
    with_inserts = repair.repaired(df.where("conv_id = 'd'"), costs=Costs(insert=1, delete=5)).orderBy("position").collect()
    assert [(r.role, r.text, r.edit) for r in with_inserts] == [("user", "Alone.", "K"), ("assistant", "", "I")]


def test_editor_follows_inserts():
    editor = Editor("IKI")
    assert list(editor.row("assistant", "x")) == [("I", "user", ""), ("K", "assistant", "x")]
    assert list(editor.end())[0] == ("I", "user", "")
