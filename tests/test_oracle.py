"""Every registered query against its DuckDB oracle (sf0.001), order-insensitive."""

import pandas as pd
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


def _cv(v):
    if v is None or v is pd.NA or (isinstance(v, float) and v != v):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        v = round(v, 6)
        return int(v) if v.is_integer() else v
    return v


def canon(df):
    df = df[sorted(df.columns)].astype(object)
    return sorted((tuple(_cv(v) for v in r) for r in df.itertuples(index=False)), key=repr)


# SURVEY section 2 check kinds: Q = DuckDB oracle, P = property test plus a rows-only entry.
Q_IDS = ("S1 S2 S4 S5 S7 P1 P2 P3 P6 P7 P8 P9 P10 P12 " + " ".join(f"F{i}" for i in range(1, 23)) +
         " J1 J2 J3 J4 J5 J6 " + " ".join(f"A{i}" for i in range(1, 21)) +
         " W1 W3 W4 W5 W6 W7 W8 W9 W10 W11 W12 W13 W14 T1 T2 T3 T4 U1 N1 N2 N3 N4"
         " E1 E2 E3 E4 E5 E6 E7 M1 M5 M15 V1 V2 V3 V4 V5 V6 V7 R3 R4 R7 G1 G2 G3 G4 G5").split()
P_IDS = ("S3 S6 S8 P4 P5 P11 P13 W2 T5 T6 E8 M2 M3 M4 M6 M7 M8 M9 M10 M11 M12 M13 M14"
         " R1 R2 R5 R6 X1 X2 X3 X4 G6 G7 G8 G9 G10 G11 G12").split()


def _ids(names):
    return {n.split("_")[0] for n in names}


def test_survey_inventory_is_registered():
    assert len(Q_IDS) == 109 and len(P_IDS) == 38
    assert not set(Q_IDS) - _ids(ORACLE), sorted(set(Q_IDS) - _ids(ORACLE))
    assert not set(P_IDS) - _ids(QUERIES), sorted(set(P_IDS) - _ids(QUERIES))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = duck.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canon(got) == canon(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    QUERIES[name](spark, SF_SMALL).count()


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["date", "day_name", "rank", "series", "hour_minute", "tpm", "tpm_ma_6",
                          "vs_rolling_mean_pct"]
    assert len(rows) == 10
