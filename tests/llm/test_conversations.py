import hashlib
import random
from zlib import crc32

from daybook.llm import conversations as C
from daybook.llm.conversations import Audits, damage, finish, repair, solve
from daybook.llm.queries import ORACLES, op13_conversation_repair
from workload.compare import connect, differences

SPACES = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        told = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        kind = crc32(":".join(told[:2]).encode()) % 20
        role, text = told[2], told[3]
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain_repair(rows):
    """By all edits of each row, with whole strings; the rows are of one conversation."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, f"{r[2]}:{r[3]}".encode()))
    faults, seen = [], set()
    for _, _, role, text in rows:
        end = text.rstrip(SPACES)[-1:]
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "" if end in ".!?" else "truncated")
        seen.add((role, text))
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def inserts(states):
        todo = dict(states)
        for _ in range(3):
            for (last), (cost, audit, lines) in list(todo.items()):
                for role in follow[last].replace("s", ""):
                    new = (cost + 3, audit + "I", (*lines, names[role] + ":"))
                    todo[role] = min(todo.get(role, new), new, key=lambda v: v[:2])
        return todo

    states = {"": (0, "", ())}
    for (_, _, role, text), fault in zip(rows, faults):
        then = {}

        def offer(last, new):
            then[last] = min(then.get(last, new), new, key=lambda v: v[:2])

        for last, (cost, audit, lines) in inserts(states).items():
            offer(last, (cost + 4, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault else 0
            if role[:1] and role[0] in follow[last]:
                offer(role[0], (cost + more, audit + "K", (*lines, f"{role}:{text}")))
            for r in follow[last].replace("s", ""):
                offer(r, (cost + 3 + more, audit + "R", (*lines, f"{names[r]}:{text}")))
        states = then
    cost, audit, lines = min((v for k, v in inserts(states).items() if k in ("", "a")), key=lambda v: v[:2])
    turns = {r[1] for r in rows if r[1] is not None}
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def plain(rows, damaged):
    return sorted(((c, *plain_repair([r for r in damaged if r[0] == c])) for c in {r[0] for r in rows}), key=repr)


def random_rows(rng, conversations, longest):
    texts = ["Yes.", "No!", "and so", " ", "", None, "What?", "ends. \n", "a:b."]
    roles = ["user", "assistant", "system", "tool", "", None, "user:x"]
    rows = []
    for conv in [None, *range(conversations)]:
        for turn in range(rng.randrange(1, longest)):
            rows.append((
                conv, rng.choice([turn, turn, turn, None, 3]),
                rng.choice(roles) if rng.random() < 0.3 else roles[turn % 2],
                rng.choice(texts) if rng.random() < 0.5 else f"text {rng.randrange(40)}.",
            ))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_same_as_plain_on_random_rows(spark):
    rng = random.Random(4)
    rows = random_rows(rng, 150, 12)
    table = frame(spark, rows)
    assert rows_of(repair(table)) == plain(rows, [tuple(" " if v is None and i > 1 else v for i, v in enumerate(r)) for r in rows])
    damaged = damage(table)
    assert rows_of(repair(damaged, present=damaged.present)) == plain(rows, plain_damage(rows))


def test_conversations_over_several_tasks(spark):
    rng = random.Random(5)
    rows = random_rows(rng, 3, 6) + [(77, *r[1:]) for r in random_rows(rng, 60, 12)]
    rows += [(77, None, "user", "same.")] * 30 + [(78, n % 9, "tool", f"t{n % 50}") for n in range(120)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = rows_of(repair(frame(spark, rows).repartition(5)))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found == plain(rows, [tuple(" " if v is None and i > 1 else v for i, v in enumerate(r)) for r in rows])


def test_parts_joined_at_any_cut_are_the_whole():
    rng = random.Random(6)
    for _ in range(300):
        part = C.Part(1)
        rows = [(rng.choice(["user", "assistant", "system", "x"]), rng.choice(["A.", "b", ""])) for _ in range(rng.randrange(25))]
        for n, (role, text) in enumerate(rows):
            part.add(n, role, text, 1, True)
        cuts = sorted(rng.randrange(len(rows) + 1) for _ in range(3))
        parts = []
        for k, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
            piece = C.Part(1)
            for n in range(a, b):
                piece.add(n, *rows[n], 1, True)
            parts.append(piece.result(k, True))
        whole, joined = part.result(0, True), C.join_parts(parts)
        for c in ("cost", "audit", "illegal", "turns", "least_turn", "most_turn"):
            assert joined[c] == whole[c]


def test_ties_by_common_prefix_even_if_hashes_collide(monkeypatch):
    rng = random.Random(7)
    for mod in ((1 << 61) - 1, 3, 1):
        monkeypatch.setattr(C, "_MOD", mod)
        audits = Audits()
        strings = ["".join(rng.choice("DIKR") for _ in range(rng.randrange(12))) for _ in range(150)]
        nodes = [audits.add(0, s) for s in strings]
        assert [audits.text(n) for n in nodes] == strings
        for a, x in zip(nodes, strings):
            assert [audits.less(a, b) for b in nodes] == [x < y for y in strings]


def test_long_conversation_and_long_text(spark):
    kinds = [("u" if n % 2 == 0 else "a", "" if n % 7 else "truncated") for n in range(50_000)]
    cost, audit = finish(solve(kinds))
    assert cost == 3 * sum(f == "truncated" for _, f in kinds) and audit == "K" * 50_000
    text = "word " * 400_000 + "end."
    out = repair(frame(spark, [(1, 0, "user", text), (1, 1, "assistant", "Yes.")])).first()
    assert out.repaired_sha256 == hashlib.sha256(f"user:{text}\nassistant:Yes.".encode()).hexdigest()


def test_no_rows_empty_table_and_clashing_names(spark):
    gone = next(n for n in range(1000) if crc32(f"{n}:0".encode()) % 20 == 0)
    names = "present line mark copies first kind copy edge part cost audit c n earliest".split()
    rows = [(gone, 0, "user", "Hello.", *"x" * len(names))]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, " + ", ".join(f"{c} string" for c in names))
    damaged = damage(table)
    empty = hashlib.sha256(b"").hexdigest()
    assert rows_of(repair(damaged, present=damaged.present)) == [(gone, 0, 0, 0, 0, 0, 0, "", empty)]
    assert rows_of(repair(table)) == [(gone, 0, 0, 0, 0, 0, 3, "KI", hashlib.sha256(b"user:Hello.\nassistant:").hexdigest())]
    assert repair(damage(table.limit(0))).count() == 0


def test_same_as_sql(spark, sf_dir):
    assert differences(op13_conversation_repair(spark, sf_dir), connect(sf_dir), ORACLES["op13_conversation_repair"]) == ""
