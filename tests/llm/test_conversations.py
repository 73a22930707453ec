import functools
import hashlib
import random
import re
import zlib

from campfin.llm.conversations import (applied, cheapest, damage, judge_conversations,
                                       repair_conversations)
from campfin.llm.q_conversations import op13_conversation_repair

OK = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def faults(rows):
    """(blank, duplicate, truncated) flags of every row, first fault only."""
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(SPACE)
        if not body:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def search(rows):
    """Cheapest (cost, audit, turns) by trying all edits; the roles so far are
    carried as text and matched against the wanted pattern at the end."""
    bad = faults(rows)

    def may(roles):  # can this text still grow into a wanted one
        return any(OK.fullmatch(roles + x) for x in ("", "a", "ua"))

    @functools.cache
    def best(i, roles, inserts):
        found = []
        if i == len(rows) and OK.fullmatch(roles):
            found.append((0, "", ()))
        steps = []
        if inserts < 3:
            steps += [("I", 3, r, (r, "")) for r in ("user", "assistant")]
        if i < len(rows):
            role, text = rows[i]
            steps.append(("D", 4, None, None))
            if bad[i] not in ("blank", "duplicate"):
                cut = 3 * (bad[i] == "truncated")
                if role:
                    steps.append(("K", cut, role, (role, text)))
                steps += [("R", 3 + cut, r, (r, text)) for r in ("user", "assistant")]
        for letter, cost, role, turn in steps:
            then = roles + (role[0] if role else "")
            then = then.replace("uaua", "ua")  # the same future
            if may(then):
                c, a, t = best(i + (letter != "I"), then, inserts + 1 if letter == "I" else 0) or (None,) * 3
                if c is not None:
                    found.append((c + cost, letter + a, ((turn,) if turn else ()) + t))
        return min(found, key=lambda x: x[:2]) if found else None

    return best(0, "", 0)


def brute(rows):
    """The contract's columns of one conversation's (turn, role, text) rows after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    turns = {t for t, _, _ in rows if t is not None}
    said = [r[1:] for r in rows]
    bad = faults(said)
    cost, audit, left = search(tuple(said))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, bad.count("blank"),
            bad.count("duplicate"), bad.count("truncated"),
            sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:])),
            cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest())


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k == 1:
            text = ""
        elif k == 2:
            text = re.sub("[.!?]", "", text)
        elif k == 4:
            role = "user"
        mine += [(turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


COLS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id long, turn long, role string, text string"


def made(n, seed):
    rnd = random.Random(seed)
    rows = []
    for conv in [None, *range(n)]:
        at = rnd.choice([0, 0, 3])
        for _ in range(rnd.randint(1, 9)):
            at += rnd.choice([1, 1, 1, 1, 3, 0])
            rows.append((conv, rnd.choice([at] * 12 + [None]),
                         rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "User", "", None]),
                         rnd.choice(["Hi.", "Yes!", "So?", "cut", "", " \n", None, "é. ", f"line {rnd.random()}."])))
    return rows


def test_query_equals_search_over_all_edits(spark, tmp_path):
    rows = made(400, 3)
    spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "'x' as audit", "7L as gaps", "'r' as _role").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: tuple(r[c] for c in COLS) for r in op13_conversation_repair(spark, str(tmp_path)).collect()}
    want = {k: brute(v) for k, v in damaged(rows).items()}
    assert got == want and len(got) == 401
    assert set("DIKR") <= set("".join(v[6] for v in want.values()))


def test_long_conversations_take_the_second_way(spark):
    rows = made(150, 5)
    for i in range(300):
        rows.append((7, 20 + i, ["user", "assistant"][i * i % 3 % 2], ["Hi.", f"t {i}.", f"cut {i}"][i % 7 % 3]))
    df = damage(spark.createDataFrame(rows, SCHEMA))
    one = judge_conversations(df, count_col="copies")
    two = judge_conversations(df, count_col="copies", long_rows=2)
    three = judge_conversations(df, count_col="copies", long_chars=9)
    a, b, c = (sorted((tuple(r) for r in x.collect()), key=str) for x in (one, two, three))
    assert a == b == c and len(a) == 151


def test_blocks_do_not_change_the_choice():
    rnd = random.Random(1)
    for _ in range(300):
        codes = bytes(rnd.choice([0, 1, 2, 3, 4, 5, 6, 7, 8]) for _ in range(rnd.randint(0, 40)))
        assert cheapest(codes, 1) == cheapest(codes, 3) == cheapest(codes, 1000)


def test_block_choice_equals_search():
    rnd = random.Random(2)
    roles = ["system", "user", "assistant", "tool"]
    for _ in range(400):
        codes = bytes(rnd.choice([0, 1, 1, 2, 2, 3, 5, 6, 8]) for _ in range(rnd.randint(0, 7)))
        rows = tuple((roles[c & 3], "" if c == 8 else f"{i}" + ("" if c & 4 else ".")) for i, c in enumerate(codes))
        cost, audit, left = search(rows)
        assert cheapest(codes, 2) == (cost, audit)
        assert tuple((r, t) for x, r, t in applied(audit, iter(rows)) if x != "D") == left


def test_one_very_long_conversation_is_linear():
    codes = bytes([1, 2, 1, 1, 8, 6, 0, 2] * 20_000)
    cost, audit = cheapest(codes)
    assert sum(x != "I" for x in audit) == len(codes) and cost > 0


def test_repaired_turns(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "assistant", "Bye."), (2, 0, "user", " "),
            (3, 0, "system", "S."), (3, 1, "user", "Q?"), (3, 2, "assistant", "A."), (3, 2, "assistant", "A.")]
    got = sorted(tuple(r) for r in repair_conversations(spark.createDataFrame(rows, SCHEMA)).collect())
    assert [x for x in got if x[0] == 3] == [(3, 0, "K", "system", "S."), (3, 1, "K", "user", "Q?"),
                                             (3, 2, "K", "assistant", "A.")]
    assert [(x[2], x[3]) for x in got if x[0] == 1] == [("R", "user"), ("K", "assistant")]
    assert not [x for x in got if x[0] == 2]


def test_empty_table_and_all_dropped(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert judge_conversations(damage(empty), count_col="copies").count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = damage(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA))
    assert [tuple(r) for r in judge_conversations(df, count_col="copies").collect()] == [
        (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
