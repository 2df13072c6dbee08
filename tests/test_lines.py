"""Line parsers on hand-traced cases, and against sequential loops on random text."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tariffmill.functions import lines as L
from tariffmill.patterns import Rules

PLAIN = Rules(boilerplate=(), document_keys=(), label_rules=())


def text(*parts):
    return "\n".join(parts)


def run_docs(value, *parts):
    found = value(L.parse_documents(F.col("t"), PLAIN), t=text(*parts))
    return [(d["code"], d["name"], d["issuer"]) for d in found]


def run_agreements(value, *parts):
    found = value(L.parse_agreements(F.col("t"), PLAIN), t=text(*parts))
    return [(a["country"], a["list"], a["DI"], a["TPI"]) for a in found]


def labels(value, code, designation, *parts):
    column = L.hierarchy_labels(F.col("t"), F.col("c"), F.col("d"), PLAIN)
    return tuple(value(column, t=text(*parts), c=code, d=designation).values())


def test_lines_strip_and_drop_blanks(value):
    assert value(L.text_lines(F.col("t")), t=" a \r\n\n \t\nb c d") == ["a", "b c", "d"]
    assert value(L.text_lines(F.col("t")), t=None) == []


def test_documents(value):
    got = run_docs(value, "A", "06002", "Cert", "ONSSA", "extra", "06003", "Lic", "MIN", "06002", "Cert", "ONSSA")
    assert got == [("06002", "Cert", "ONSSA"), ("06003", "Lic", "MIN")]
    assert run_docs(value, "06002") == [("06002", "NA", "NA")]
    assert run_docs(value, "06002", "NA", "Cert", "NA", "ONSSA") == [("06002", "Cert", "ONSSA")]
    assert run_docs(value, "no code here") == []


def test_agreements(value):
    got = run_agreements(
        value, "Accords", "Liste", "DI", "UE", "LISTE A", "ANNEXE 1", "2.5", "0", "TUNISIE", "FRANCHISE", "0", "0.25",
        "9", "(*) Taux du Régime du Droit Commun",
    )
    assert got == [("UE", "LISTE A ANNEXE 1", "2.5", "0"), ("TUNISIE", "FRANCHISE", "0", "0.25")]
    assert run_agreements(value, "UE", "(*)") == [("UE", "NA", "NA", "NA")]


def test_history(value):
    got = value(L.parse_history(F.col("t")), t=text("Titre", "01/01/2020", "x", "10 %", "01/02/2021"))
    assert got == [{"date": "2020-01-01", "raw": "Taux: 10 %"}, {"date": "2021-02-01", "raw": "Taux: "}]
    assert value(L.parse_history(F.col("t")), t="31/02/2020") == [{"date": None, "raw": "Taux: "}]


def test_hierarchy_labels(value):
    full = ("noise", "Codification", "01.01", "Chevaux", "0101.21", "Reproducteurs", "00", "huit", "00", "dix", "123", "U")
    assert labels(value, "0101210000", "D", *full) == ("Chevaux", "Reproducteurs", "huit", "dix")
    assert labels(value, "0101210000", "D", *full[:8], "U") == ("Chevaux", "Reproducteurs", "huit", "D")
    assert labels(value, "0101210000", "D", "") == ("NA", "NA", "NA", "D")


def test_final_designation(value):
    final = L.final_designation(F.col("a"), F.col("b"))
    assert value(final, a="NA", b="D") == "D"
    assert value(final, a="dix", b="D") == "dix"


@pytest.mark.parametrize(
    ("parts", "metadata", "unit"),
    [
        (("A", "kg"), {}, "kg"),
        (("A", "Kilogramme"), {"unit": "KG"}, "KG"),
        (("A", "Kilogramme"), {}, "U"),
        (("",), {"unit": "KG"}, "NA"),
    ],
)
def test_unit(value, parts, metadata, unit):
    assert value(L.unit_of_measure(F.col("t"), F.col("m")), t=text(*parts), m=metadata) == unit


def loop_hierarchy(lines, code):
    """Sequential reading of the level rules, for comparison."""
    level, out = None, {"HS4": [], "HS6": [], "HS8": [], "HS10": []}
    for line in lines:
        if line == f"{code[:2]}.{code[2:4]}":
            level = "HS4"
        elif line == f"{code[:4]}.{code[4:6]}":
            level = "HS6"
        elif level == "HS6" and line == code[6:8]:
            level = "HS8"
        elif level == "HS8" and line == code[8:10]:
            level = "HS10"
        elif level and not line.replace(".", "").isdigit():
            out[level].append(line)
    return out


def loop_agreements(lines):
    out = []
    for line in lines:
        rate = line in ("2.5", "0", "7 %")
        if rate and out:
            free = next((k for k in ("DI", "TPI") if out[-1][k] == "NA"), None)
            if free:
                out[-1][free] = line
        elif line.startswith("LISTE") and out:
            out[-1]["list"] = line if out[-1]["list"] == "NA" else f"{out[-1]['list']} {line}"
        elif not rate and not line.startswith("LISTE"):
            out.append({"country": line, "list": "NA", "DI": "NA", "TPI": "NA"})
    seen = []
    for record in out:
        if record not in seen:
            seen.append(record)
    return [tuple(r.values()) for r in seen]


def loop_documents(lines):
    out = []
    for line in lines:
        if line == "AD":
            continue
        if line.isdigit() and 3 <= len(line) <= 5:
            out.append([line, "NA", "NA"])
        elif out and "NA" in out[-1]:
            out[-1][out[-1].index("NA")] = line
    return list(dict.fromkeys(map(tuple, out)))


def loop_history(lines):
    return [
        f"Taux: {lines[i + 2] if i + 2 < len(lines) else ''}" for i, line in enumerate(lines) if line[2:3] == "/"
    ]


def test_against_loops(spark):
    rng = random.Random(7)
    code = "0101212121"
    words = ["01.01", "0101.21", "21", "21", "mot", "autre mot", "12.3"]
    rates = ["UE", "Turquie", "LISTE A", "LISTE B", "2.5", "0", "7 %"]
    papers = ["123", "4567", "12", "NA", "Certificat", "ORG", "AD", "123456"]
    days = ["01/01/2020", "15/02/2021 fin", "x", "10 %", "le 01/01/2020"]
    rows = []
    for i in range(600):
        rows.append((
            i,
            [rng.choice(words) for _ in range(rng.randint(0, 12))],
            [rng.choice(rates) for _ in range(rng.randint(0, 12))],
            [rng.choice(papers) for _ in range(rng.randint(0, 12))],
            [rng.choice(days) for _ in range(rng.randint(0, 9))],
        ))
    df = spark.createDataFrame(rows, "i int, h array<string>, a array<string>, d array<string>, y array<string>")
    got = df.select(
        "i",
        F.struct(*[
            L.level_lines(L.hierarchy_segments(F.col("h"), F.lit(code)), level).alias(level) for level in L.LEVELS
        ]).alias("h"),
        L.parse_agreements(F.array_join("a", "\n"), PLAIN).alias("a"),
        L.parse_documents(F.array_join("d", " \r\n\n\t"), PLAIN).alias("d"),
        L.parse_history(F.array_join("y", "\n")).alias("y"),
    ).collect()
    by_id = {i: rest for i, *rest in rows}
    for row in got:
        h, a, d, y = by_id[row["i"]]
        assert row["h"].asDict() == loop_hierarchy(h, code)
        assert [(r["country"], r["list"], r["DI"], r["TPI"]) for r in row["a"]] == loop_agreements(a)
        assert [(r["code"], r["name"], r["issuer"]) for r in row["d"]] == loop_documents(d)
        assert [r["raw"] for r in row["y"]] == loop_history(y)


def test_long_text_is_linear(value):
    """60,000 lines in one cell, all of them document starts or country names."""
    docs = text(*[f"{i % 90000 + 10000}" for i in range(60_000)])
    assert len(value(L.parse_documents(F.col("t")), t=docs)) == 60_000
    countries = text(*[f"Pays {i}" for i in range(60_000)])
    assert len(value(L.parse_agreements(F.col("t")), t=countries)) == 60_000


def test_white_space_is_sought_only_where_it_can_be():
    from tariffmill.functions import lines as L
    from tariffmill.functions import text as T

    assert all(re.match(r"[\x00-\x20\x85\xa0 -　]", c) for c in T.WHITESPACE)
    for pattern in (L._UNTIDY, L._LINE_END, T._WS_RUN):
        assert pattern.startswith(f"(?U){T.WS_AHEAD}(?:")
