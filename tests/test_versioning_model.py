"""versioned_merge against a plain-Python model on random load sequences."""

import datetime as dt
import random

from ledgerlake.operators import versioning as v

SPEC = v.VersionSpec(keys=("k",), payload=("k", "a", "b"), record_type="T")
SCHEMA = "k string, a string, b int"


def model_merge(table, batch, mode, day):
    """table: key -> list of version dicts (ordered)."""
    seen = set()
    for k, a, b in batch:
        seen.add(k)
        versions = table.setdefault(k, [])
        cur = versions[-1] if versions else None
        if cur is None:
            versions.append(dict(a=a, b=b, version=1, current=True, delete=None, valid_from=day, valid_to=None))
        elif (cur["a"], cur["b"]) != (a, b) or cur["delete"] == "Y":
            cur.update(current=False, valid_to=day)
            versions.append(dict(a=a, b=b, version=cur["version"] + 1, current=True, delete=None,
                                 valid_from=day, valid_to=None))
    if mode == "full":
        for k, versions in table.items():
            cur = versions[-1]
            if k not in seen and cur["delete"] != "Y":
                cur.update(current=False, valid_to=day)
                versions.append(dict(a=cur["a"], b=cur["b"], version=cur["version"] + 1, current=True,
                                     delete="Y", valid_from=day, valid_to=None))


def as_rows(table):
    return sorted((k, x["version"], x["current"], x["a"], x["b"], x["delete"], x["valid_from"], x["valid_to"])
                  for k, versions in table.items() for x in versions)


def test_random_load_sequences_match_model(spark):
    rnd = random.Random(11)
    for _ in range(3):
        fact, model = None, {}
        for step in range(4):
            day = dt.date(2024, 1, 1) + dt.timedelta(days=7 * step)
            keys = rnd.sample([str(i) for i in range(12)], rnd.randint(3, 10))
            batch = [(k, rnd.choice(["x", "y", None]), rnd.choice([1, 2])) for k in keys]
            mode = rnd.choice(["delta", "full"])
            df = spark.createDataFrame(batch, SCHEMA)
            stamp = v.LoadStamp(str(day), "run", f"{day} 01:00:00")
            fact = v.initial_load(spark, df, SPEC, stamp) if fact is None else v.versioned_merge(fact, df, SPEC, stamp, mode)
            fact = spark.createDataFrame(fact.collect(), fact.schema)  # cut lineage, as the store does
            model_merge(model, batch, "delta" if step == 0 else mode, day)
        got = sorted((r["k"], r[v.VERSION], r[v.CURRENT], r["a"], r["b"], r[v.DELETE], r[v.VALID_FROM], r[v.VALID_TO])
                     for r in fact.collect())
        assert got == as_rows(model)
