"""Large JSON files read in splits."""
import json
import random

import pytest

from regiolake.sources import json_series as J


def _series(rnd, i):
    odd = rnd.choice(["a", 'q"{', "}]", "\\", '\\"', "é{[", "x\ny", "]}\\\\", ""])
    return {"Nombre": f"{i} {odd}", "T3_Unidad": odd, "MetaData": [{"T3_Variable": "v{", "Nombre": odd} for _ in range(rnd.randrange(3))],
            "Data": [{"Anyo": 2000 + k, "Valor": odd if k % 3 == 0 else k, "Fecha": "}"} for k in range(rnd.randrange(6))]}


def _key(r):
    return (r["Nombre"], r["T3_Unidad"], [tuple(m) for m in r["MetaData"]], [tuple(p) for p in r["Data"]])


@pytest.mark.parametrize("size", [97, 1 << 20])
def test_splits_give_the_series_of_whole_files(spark, tmp_path, size):
    rnd = random.Random(size)
    many = [_series(rnd, i) for i in range(60)]
    texts = {"list": json.dumps(many), "lines": json.dumps(many, indent=2, ensure_ascii=False),
             "wrapped": json.dumps({"Meta": {"a": {"b": "{["}, "c": 1}, "Data": many[:20], "End": {"x": {}}}), "empty": "[]", "none": '{"Data": []}',
             "bare": '\n [ {} , {"Nombre":"only"} ]\n'}
    for n, t in texts.items():
        (tmp_path / f"{n}.json").write_text(t, encoding="utf-8")
    want = sorted(_key(r) for r in J.read_series(spark, str(tmp_path / "*.json")).collect() if r["Nombre"])
    conf = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = J.read_series_splits(spark, str(tmp_path / "*.json")).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(_key(r) for r in got if r["Nombre"]) == want and len(want) == 141
    mine = sorted((r["series_at"], r["Nombre"]) for r in got if r["file"].endswith("/list.json"))
    assert [n for _, n in mine] == [s["Nombre"] for s in many]
