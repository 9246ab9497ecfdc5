"""Conversation repair, SimHash links and fill-in-the-middle against plain versions."""
import hashlib
import random
import re
from collections import Counter
from heapq import heappop, heappush

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lociframe.llm import conversation_repair as cr
from lociframe.llm import simhash_pigeonhole as sp
from lociframe.llm.fill_in_middle import fill_in_middle, restore
from lociframe.llm.queries import QUERIES, damaged

from .helpers import SCHEMA, awkward, frame, groups, lower

# conversation repair


def cheapest(symbols: str) -> tuple[int, str]:
    """Uniform-cost search by (cost, letters) over the whole conversation."""
    heap, done = [(0, "", 0, 0)], set()
    while heap:
        cost, audit, i, q = heappop(heap)
        if (i, q) in done:
            continue
        done.add((i, q))
        if i == len(symbols) and q in (0, 3):
            return cost, audit
        heappush(heap, (cost + 2, audit + "I", i, cr.NEXT[q]))
        if i < len(symbols):
            s = symbols[i]
            extra = int(s.isupper())
            heappush(heap, (cost + 3, audit + "D", i + 1, q))
            if s != "x":
                heappush(heap, (cost + 2 + extra, audit + "R", i + 1, cr.NEXT[q]))
                if (s.lower(), q) in cr.KEEPS:
                    heappush(heap, (cost + extra, audit + "K", i + 1, cr.KEEPS[s.lower(), q]))


@pytest.mark.parametrize("seed", range(4))
def test_auction_finds_the_first_of_the_cheapest(seed):
    rng = random.Random(seed)
    for _ in range(150):
        symbols = "".join(rng.choice("suaSUAox") for _ in range(rng.randint(1, 14)))
        audit, state = cr.solve(symbols)
        audit += cr.ENDING[state]
        cost, _, _ = cr.replayed(symbols, ["system"] * len(symbols), [""] * len(symbols), audit, 0)
        assert (cost, audit) == cheapest(symbols)


def test_prices_are_dual_feasible_and_meet_the_cost():
    arcs = cr.lattice("suaUxxAou", cr.COMPLETE)
    prices = [0] * len(arcs)
    cr.auction(arcs, 0, prices)
    assert all(prices[i] <= cost + prices[j] for i, out in enumerate(arcs) for _, cost, j in out)
    assert prices[0] == cheapest("suaUxxAou")[0] and prices[-1] == 0


def test_chunks_chain_to_the_whole():
    rng = random.Random(9)
    for _ in range(60):
        symbols = "".join(rng.choice("suaSUAox") for _ in range(rng.randint(5, 40)))
        parts = [symbols[i : i + 5] for i in range(0, len(symbols), 5)]
        exits, state, audit = cr.exits_of([cr.passage_costs(p) for p in parts]), 0, ""
        for p, e in zip(parts, exits, strict=True):
            some, state = cr.solve(p, e, state)
            audit += some
        assert audit + cr.ENDING[state] == cheapest(symbols)[1]


def plain_repair(rows):
    """Registered columns of one conversation, by search over all of its rows."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, symbols, faults = set(), "", Counter()
    for _, role, text in rows:
        last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else ""
        seen.add((role, text))
        faults[fault] += 1
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        symbols += "x" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
    cost, audit = cheapest(symbols)
    _, roles, texts = cr.replayed(symbols, [r[1] for r in rows], [r[2] for r in rows], audit, 0)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    repaired = "\n".join(f"{r}:{t}" for r, t in zip(roles, texts, strict=True))
    return gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256(repaired.encode()).hexdigest()


def conversations(seed=3):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(40)]:
        for turn in range(rng.choice([1, 2, 5, 9, 150 if conv == 7 else 4])):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "Hm", "", " \n", None, f"Word {rng.randrange(50)}?", "日本語。", "É."])
            rows.append((conv, rng.choice([turn, turn, turn, None, 3]), role, text, "x", 1))
    rows += [(50, t, "user" if t % 2 else "assistant", f"Turn {t % 90}.", None, None) for t in range(700)]
    rows += [(51, 1, "user", "Same.", None, None)] * 5 + [(52, 0, "user", "long " * 200_000, None, None), (52, 1, "assistant", "Well.", None, None)]
    rows += [(53, 9_000_000_000, "user", "Far.", None, None)]
    return rows


TURNS = "conv_id long, turn long, role string, text string, audit string, cost int"


@pytest.mark.parametrize("chunk", [64, 3])
def test_repair_matches_plain(spark, chunk):
    rows = conversations()
    turns = spark.createDataFrame(rows, TURNS).repartition(5)
    got = {r[0]: tuple(r[1:]) for r in with_hash(cr.repair(turns, chunk)).collect()}
    held = {}
    for conv, turn, role, text, *_ in rows:
        held.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    assert got == {conv: plain_repair(some) for conv, some in held.items()}


def with_hash(repaired):
    listed = cr.repaired_turns(repaired).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "chunk", "at", "role", "text"))).alias("t"))
    lines = F.array_join(F.transform("t", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    listed = listed.select(F.col("conv_id").alias("c"), lines.alias("lines"))
    both = cr.summary(repaired).join(listed, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    return both.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.sha2(F.coalesce("lines", F.lit("")), 256))


def test_repair_query_with_nulls_and_dropped_conversations(spark, tmp_path):
    rows = conversations(5)
    spark.createDataFrame(rows, TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    got = QUERIES["op11_conversation_repair"](spark, str(tmp_path)).collect()
    assert Counter(r.conv_id for r in got) == Counter({r[0]: 1 for r in rows})
    import zlib

    held = {r[0]: [] for r in rows}
    for conv, turn, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            held[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert {r.conv_id: tuple(r[1:]) for r in got} == {c: plain_repair(some) if some else none for c, some in held.items()}
    assert any(not some for some in held.values())


def test_repair_of_no_rows(spark, tmp_path):
    empty = spark.createDataFrame([], TURNS)
    assert cr.summary(cr.repair(damaged(empty))).count() == 0
    empty.write.parquet(f"{tmp_path}/conversations.parquet")
    assert QUERIES["op11_conversation_repair"](spark, str(tmp_path)).count() == 0


# SimHash links


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, ids, most=4):
    at = np.array(prints, np.uint64)
    a, b = np.nonzero(np.bitwise_count(at[:, None] ^ at[None, :]) <= most)
    head = groups(len(prints), zip(a.tolist(), b.tolist(), strict=True))
    least = {}
    for h, i in zip(head, ids, strict=True):
        least[h] = min([x for x in (least.get(h), i) if x is not None], default=None)
    return [least[h] for h in head]


def test_simhash_matches_plain(spark, tmp_path):
    rows = awkward(6)
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_simhash_pigeonhole"](spark, str(tmp_path)).collect()
    prints = [plain_fingerprint(r[1]) for r in rows]
    least = plain_components(prints, [r[0] for r in rows])
    assert Counter(map(tuple, got)) == Counter((r[0], f"{p:016x}", c) for r, p, c in zip(rows, prints, least, strict=True))


def clustered(seed, n=600):
    """Fingerprints in dense and sparse groups around a few centres, with copies and some frequent parts."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, 5, dtype=np.uint64) * np.uint64(2)
    prints = centres[rng.integers(0, 5, n)]
    for _ in range(5):
        flip = np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)
        prints = np.where(rng.random(n) < 0.7, prints ^ flip, prints)
    common = (rng.integers(0, 1 << 63, n // 3, dtype=np.uint64) & ~np.uint64(0xFFFFF)) | np.uint64(0x12345)
    return np.concatenate([prints, common, prints[:20], np.zeros(2, np.uint64), np.array([1, 31, 1 << 63], np.uint64)])


@pytest.mark.parametrize(("partitions", "block"), [((2, 3, 4, 5), 50_000), ((3,), 40), ((4,), 50_000), ((5,), 25)])
def test_links_by_pigeonhole_match_all_pairs(spark, monkeypatch, partitions, block):
    monkeypatch.setattr(sp, "PARTITIONS", partitions)
    prints = clustered(partitions[0])
    rows = [(i, int(p)) for i, p in enumerate(prints.view(np.int64))] + [(None, int(prints.view(np.int64)[3]))]
    got = sp.near_duplicates(spark.createDataFrame(rows, "doc_id long, fingerprint long").repartition(4), block=block).collect()
    expected = plain_components(prints, range(len(prints)))
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter([*enumerate(expected), (None, expected[3])])


def test_thresholds_spend_the_units_where_candidates_are_few():
    prints = clustered(11, 3000)
    prints = np.unique((prints & ~np.uint64(0xFFFF)) | np.uint64(0xABCD) * (np.arange(len(prints)) % 9 > 0).astype(np.uint64))
    both = sp.together(prints)
    groups_ = sp.partitions(both, len(prints), 4)
    assert sorted(b for g in groups_ for b in g) == list(range(64))
    chosen = sp.Allocation(groups_, sp.part_counts(groups_, prints), len(prints), 4)
    thresholds, cost = chosen.thresholds(sp.bit_matrix(prints))
    assert ((thresholds + 1).sum(axis=1) == 5).all() and (thresholds >= -1).all()
    assert len(np.unique(thresholds, axis=0)) > 1  # unequal, by fingerprint

    def price(i, t, q):  # of one partition, as the allocation sees it
        alone = sp.Allocation([groups_[i]], sp.part_counts([groups_[i]], prints), len(prints), t)
        return alone.thresholds(sp.bit_matrix(prints[q : q + 1]))[1][0]

    from itertools import product

    for q in range(0, len(prints), 400):
        options = [sum(price(i, u - 1, q) for i, u in enumerate(us) if u) for us in product(range(6), repeat=4) if sum(us) == 5]
        assert abs(min(options) - cost[q]) < 1e-6 * max(1, cost[q])


def test_simhash_of_no_rows(spark):
    assert sp.near_duplicates(sp.fingerprints(spark.createDataFrame([], SCHEMA))).count() == 0


# fill in the middle


def plain_middle(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    form = "plain" if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90 else "spm" if h[3] % 100 < 20 else "psm"
    out = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    return (n, form, *((None, None) if form == "plain" else (len(p), len(m))), out)


def middle_rows():
    rows = awkward(8)
    odd = ["<P>", "a<S>b", "x <M", "<", ">P<", "a\x00b\n\r\t", "é" * 9, "\U0001F600 smile \U0001F600", "<<P", "word", "﻿bom", "ÿ\xff", "a" * 3_000_000 + " b" * 200_000]
    return rows + [(1000 + 7 * k + i, t, *[None] * 8) for i, t in enumerate(odd) for k in range(0, 300, 60)]


@pytest.mark.parametrize("slice_bytes", [4 << 20, 100])
def test_middle_matches_plain_and_is_restored(spark, slice_bytes):
    rows = middle_rows()
    docs = frame(spark, rows).withColumn("fim", F.lit(3)).withColumn("restored", F.lit("old"))
    got = restore(fill_in_middle(docs, slice_bytes=slice_bytes)).collect()
    want = Counter((r[0], r[1], *plain_middle(r[0], r[1]), r[1] or "") for r in rows)
    assert Counter((r.doc_id, r.text, *r.fim, r.restored) for r in got) == want
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == Counter((r[0], r[3], r[5]) for r in rows)
    assert {r.fim.form for r in got} == {"plain", "psm", "spm"}


def test_middle_of_no_rows_and_null_struct(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert restore(fill_in_middle(empty)).count() == 0
    none = fill_in_middle(frame(spark, awkward(1)).limit(3)).withColumn("fim", F.when(F.lit(False), F.col("fim")))
    assert [r.restored for r in restore(none).collect()] == [None] * 3
