import hashlib
import itertools
import random
import re
import zlib

import pytest

from gapweave.llm import conversations, prefixes, repair
from tests.oracle import duck, rows_of

SCHEMA = "conv_id bigint, turn bigint, role string, text string, node string, at bigint"
BLANKS = " \t\n\x0b\f\r"


def table(spark, rows):
    return spark.createDataFrame([(*row, "clash", 7) for row in rows], SCHEMA)


def sql_rows(rows, sql):
    con = duck("/root/testdata/sf0.001")
    con.execute("CREATE OR REPLACE TEMP TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", [list(row) for row in rows])
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return rows_of(columns, cursor.fetchall())


def random_rows(seed, convs, turns):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", None, "", "User", "tool"]
    texts = ["Yes.", "No", "no.\n", " ", "", None, "a b c!", "wait... what", "é?", "long " * 3000 + "."]
    rows = []
    for conv in convs:
        for turn in range(rng.randrange(turns)):
            row = (conv, rng.choice([turn, turn, turn, None, turn - 1]), rng.choice(roles[:3] * 3 + roles), rng.choice(texts))
            rows += [row] * rng.choice([1, 1, 1, 2])
    return rows


def audits(codes):
    """(cost, audit) of every way to edit, with at most two inserts in a row: all of them are tried."""
    found = []
    for letters in itertools.product("DKR", repeat=len(codes)):
        for inserts in itertools.product(range(3), repeat=len(codes) + 1):
            roles, audit, cost = "", "", 0
            ways = [""]
            for code, letter, before in zip(codes, letters, inserts):
                kind, fault = divmod(repair.CODES.index(code), 3)
                if letter != "D" and fault == 2:
                    ways = []
                    break
                audit += "I" * before + letter
                cost += 2 * before + {"D": 3, "K": 0, "R": 2}[letter] + (letter != "D") * (fault == 1)
                last = {"D": [""], "K": ["suax"[kind]], "R": ["u", "a"]}[letter]
                ways = [w + "".join(i) + x for w in ways for i in itertools.product("ua", repeat=before) for x in last]
            roles = [w + "".join(i) for w in ways for i in itertools.product("ua", repeat=inserts[-1])]
            if any(re.fullmatch("(s?(ua)+)?", r) for r in roles):
                found.append((cost + 2 * inserts[-1], audit + "I" * inserts[-1]))
    return min(found)


def test_integer_minimum_is_the_least_audit():
    rng = random.Random(1)
    for _ in range(120):
        codes = "".join(rng.choice("aabcddefgghijl") for _ in range(rng.randrange(1, 4)))
        (cost, digits) = min(
            (c + 2 * len(repair._TAIL[s]), repair.letters_of(d) + repair._TAIL[s])
            for s in repair.STATES
            if (path := repair.best_paths(codes)[s])
            for c, d in [path]
        )
        assert (cost, digits) == audits(codes), codes


def test_segments_join_to_the_path_of_the_whole():
    rng = random.Random(2)
    for _ in range(200):
        parts = ["".join(rng.choice("aabcddddefggghijl") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(1, 5))]

        def solve(pieces):
            held = []
            for at, codes in enumerate(pieces):
                paths = repair.best_paths(codes)
                ranks = {d: n for n, d in enumerate(sorted({p[1] for p in paths if p}))}
                held.append((at, [p[0] if p else -1 for p in paths], [ranks[p[1]] if p else -1 for p in paths]))
            audit, total = "", 0
            for at, pick, tail, cost in repair._choose(held[::-1]):
                audit += repair.letters_of(repair.best_paths(pieces[at])[pick][1]) + tail
                total += cost
            return total, audit

        assert solve(parts) == solve(["".join(parts)])


def test_repair_equals_sql_with_every_odd_value(spark):
    rows = random_rows(3, [*range(60), None, -7, 10**15], 9)
    rows += [(500, n, "user", "A new one.") for n in range(4)] + [(501, None, None, None)]
    got = repair.repair_damaged(table(spark, rows).repartition(5))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert rows_of(got.columns, got.collect()) == sql_rows(rows, conversations.ORACLE["op11_repair"])


def test_nothing_left_after_damage(spark):
    gone = [(c, 0, "user", "Hi.") for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert gone
    empty = hashlib.sha256(b"").hexdigest()
    got = repair.repair_damaged(table(spark, gone)).collect()
    assert sorted(map(tuple, got)) == [(c, 0, 0, 0, 0, 0, 0, "", empty) for c, *_ in gone]


def test_long_conversation_is_cut_and_joined(spark):
    """Of several segments, against one integer for all its rows."""
    rng = random.Random(4)
    rows = [(1, n, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "cut", f"{n}."])) for n in range(1500)]
    got = repair.repair_damaged(table(spark, rows)).collect()[0]
    damaged = sorted(map(tuple, repair.damage(table(spark, rows)).collect()), key=lambda r: (r[1], r[2], hashlib.sha256(r[3].encode()).digest()))
    seen, codes = set(), ""
    for _, _, role, text in damaged:
        word = text.strip(BLANKS)
        fault = 2 if not word or (role, text) in seen else 0 if word[-1] in ".!?" else 1
        seen.add((role, text))
        codes += repair.CODES[3 * "sua".index(role[0]) + fault]
    assert len(codes) > repair.SEGMENT_ROWS * 4
    cost, audit = min(
        (c + 2 * len(repair._TAIL[s]), repair.letters_of(d) + repair._TAIL[s])
        for s in (repair.START, repair.U, repair.A, repair.S)
        if (path := repair.best_paths.__wrapped__(codes)[s])
        for c, d in [path]
    )
    assert (got.cost, got.audit) == (cost, audit)


def brute_trie(rows):
    """Every prefix as the tuple of its turns."""
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn, role or "", text or ""))

    def in_order(turns):
        key = lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(f"{len(t[1])}:{t[1]}{t[2]}".encode()).digest())
        return [t[1:] for t in sorted(turns, key=key)]

    own = {c: in_order(turns) for c, turns in convs.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        rebuilt[c] = own.get(base, [])[:h] + own[c][h:]
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    result = []
    for node, who in members.items():
        below = [n for n in members if n[: len(node)] == node]
        ends = sorted(c for c in who if len(rebuilt[c]) == len(node))
        words = lambda n: len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
        result.append((
            min(who), len(node), min(members[node[:-1]]) if node else None, len(who),
            sum(len(n) == len(node) + 1 for n in below),
            sum(not any(m[:-1] == n and m for m in members) for n in below),
            sum((len(members[n]) - 1) * words(n) for n in below),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(result, key=repr)


@pytest.mark.parametrize("seed", [5, 6])
def test_trie_equals_brute_force_and_sql(spark, seed):
    rows = random_rows(seed, [*range(25), 40, 41, -19, -20, -1, None, 10**15 + 1], 5)
    rows += [(60 + n, k, "user", f"same {k}") for n in range(30) for k in range(4)] + [(97, 0, "user", "turnless")]
    got = prefixes.prefix_trie(table(spark, rows).repartition(4))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_trie(rows)
    assert rows_of(got.columns, got.collect()) == sql_rows(rows, conversations.ORACLE["op12_trie"])


def test_ends_in_several_blocks(spark):
    ids = [*range(-5000, 9000, 700), 10**12]
    rows = [(c, n, "user", "x") for c in ids for n in range(2)]
    got = prefixes.prefix_trie(table(spark, rows))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_trie(rows)


def test_empty_tables(spark):
    empty = table(spark, [])
    assert prefixes.prefix_trie(empty).collect() == []
    assert repair.repair_damaged(empty).collect() == []
