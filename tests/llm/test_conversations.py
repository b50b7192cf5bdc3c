"""Conversation repair against brute force."""

import hashlib
import heapq
import itertools
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from telemetry_lake.llm import conversations as cv

FINE = re.compile("(s?(ua)+)?")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        space = lambda v: " " if v is None else str(v)
        pick = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        role = "user" if pick == 4 else role
        text = "" if pick == 1 else re.sub("[.!?]", "", text) if pick == 2 else text
        out += [(conv, turn, role, text)] * (0 if pick == 0 else 2 if pick == 3 else 1)
    return out


def order(row):
    return (row[1] is not None, row[1] or 0, row[2].encode(), hashlib.sha256(row[3].encode()).hexdigest())


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        end = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "" if end[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(roles, kinds):
    """(cost, audit) by Dijkstra's method on (cost, edits) pairs."""
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, q = heapq.heappop(heap)
        if (i, q) in done:
            continue
        done.add((i, q))
        if i == len(roles) and q in ("", "a"):
            return cost, audit
        for to in set(step[q]) - {"s"}:
            heapq.heappush(heap, (cost + 3, audit + "I", i, to))
        if i < len(roles):
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, q))
            if kinds[i] not in ("blank", "duplicate"):
                more = 3 * (kinds[i] == "truncated")
                if roles[i][:1] in step[q] and roles[i][:1]:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, roles[i][0]))
                for to in set(step[q]) - {"s"}:
                    heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, to))
    raise AssertionError


def written(rows, audit):
    lines, q, left = [], "", iter(rows)
    for edit in audit:
        to = {"": "u", "s": "u", "u": "a", "a": "u"}[q]
        row = None if edit == "I" else next(left)
        if edit == "D":
            continue
        role = row[2] if edit == "K" else {"u": "user", "a": "assistant"}[to]
        lines.append(f"{role}:{'' if edit == 'I' else row[3]}")
        q = role[0]
    assert FINE.fullmatch("".join(x[0] for x in lines)) and next(left, None) is None
    return "\n".join(lines)


def brute(original, rows):
    out = []
    for conv in dict.fromkeys(r[0] for r in original):
        own = sorted((r for r in rows if r[0] == conv), key=order)
        kinds, known = faults(own), [r[1] for r in own if r[1] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        cost, audit = cheapest([r[2] for r in own], kinds)
        text = written(own, audit)
        out.append((conv, gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(cv.op13_conversations(spark, sf_dir)) == brute(rows, damage(rows))


def edge_rows():
    rows = [(1, 0, "user", None), (1, None, None, "Odd."), (1, 1, "", "No role."), (1, 9, "assistant", "x" * 300000 + "."),
            (None, 3, "user", "Hi."), (None, None, "assistant", "Hello!"), (None, 3, "user", "Hi."), (2, None, "system", ""),
            (3, 5, "tool", "Out."), (3, 5, "user", "Same turn?"), (3, 5, "user", "Other"), (3, 7, "User", "Capital."),
            (4, 1, "assistant", "é? "), (4, 2, "user", "é?\x0b\x0c "), (4, 2, "user", "a ."), (5, 2**62, "system", "Far.")]
    rows += [(6, t, ("user", "assistant", "system", "user")[t * t % 4], f"Text {t % 37}" + "." * (t % 3)) for t in range(300)]
    rows += [(7, None, "user", "again.")] * 90 + [(7, 3, "assistant", "Yes.")] * 40
    return rows


@pytest.mark.parametrize("size", [1, 3, cv.PIECE])
def test_edge_rows_and_pieces(spark, size):
    rows = edge_rows()
    schema = "conv_id bigint, turn bigint, role string, text string, copies int, code double, digest string, kind int"
    frame = spark.createDataFrame([(*r, 5, 0.5, "x", 1) for r in rows], schema).repartition(3)
    out = cv.audit_damaged(frame, size)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert got(out) == brute(rows, damage(rows))


def test_lost_and_empty(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(gone, 0, "user", "Hi.")], "conv_id bigint, turn bigint, role string, text string")
    assert got(cv.audit_damaged(frame)) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
    assert not cv.audit_damaged(frame.where("false")).count()


def test_one_conversation_holds_most_rows(spark):
    """Cut into pieces over several tasks; the pieces' prices give the same path as the whole."""
    rows = [(c, t, ("user", "assistant", "user", "system", "assistant")[(t * 7 + c) % 5], f"{t % 50}{'.' if t % 4 else ''}")
            for c, n in ((1, 900), (2, 5), (3, 40)) for t in range(n)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("copies", F.lit(1))
    assert got(cv.repair(frame)) == brute(rows, rows)


def every_script(rows):
    """(cost, audit) of all edits with at most two inserts at a place."""
    puts = ["", "u", "a", "uu", "ua", "au", "aa"]
    best = None
    for inserts in itertools.product(puts, repeat=len(rows) + 1):
        for edits in itertools.product(("D", "K", "u", "a"), repeat=len(rows)):
            roles, audit, cost = inserts[0], "I" * len(inserts[0]), 3 * len("".join(inserts))
            for (initial, kind), edit, more in zip(rows, edits, inserts[1:], strict=True):
                if edit != "D" and kind == "forced":
                    break
                cost += 4 if edit == "D" else (edit != "K") * 3 + 3 * (kind == "cut")
                roles += "" if edit == "D" else initial if edit == "K" else edit
                audit += edit if edit in "DK" else "R"
                roles, audit = roles + more, audit + "I" * len(more)
            else:
                if FINE.fullmatch(roles) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
    return best


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suax"), st.sampled_from(["fine", "fine", "cut", "forced"])), max_size=2))
def test_auction_against_all_scripts(rows):
    codes = tuple(16 + (8 if kind == "forced" else "suax".index(initial) + 4 * (kind == "cut")) for initial, kind in rows)
    arcs = cv.lattice(codes, cv._ENDS)
    price = cv.start_prices(arcs)
    cost = cv.auction(arcs, price, 0) + 4 * sum(kind == "forced" for _, kind in rows)
    edits, state = cv.trace(arcs, price, 0)
    assert (cost, edits + cv._LAST[state]) == every_script(rows)
    assert all(price[i] <= c + price[j] for i, out in enumerate(arcs) for _, c, j in out)
