"""Property tests: operators against small Python models on generated inputs. Each
generated batch of cases is evaluated in one Spark job."""
import json
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from threatlake.functions.common import half_up_div
from threatlake.functions.iocs import ioc_elements, ioc_struct
from threatlake.functions.urls import normalise_campaign_url
from threatlake.operators import tables as tbl

SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(0, 10 ** 9), st.integers(1, 10 ** 6)), min_size=1, max_size=40),
       st.sampled_from([(0, 1), (1, 1), (1, 100), (2, 1), (5, 1)]))
def test_half_up_div_matches_decimal(spark, pairs, spec):
    scale, factor = spec
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(half_up_div("n", "d", scale, factor)).collect()]
    q = Decimal(1).scaleb(-scale)
    want = [(Decimal(n * factor) / Decimal(d)).quantize(q, rounding=ROUND_HALF_UP) for n, d in pairs]
    assert got == want


_host = st.from_regex(r"[A-Za-z0-9]{1,8}(\.[A-Za-z0-9]{1,8}){0,2}\.(com|org|net)", fullmatch=True)
_url = st.builds(lambda scheme, www, host, path, q, frag, slashes: f"{scheme}{www}{host}{path}{q}{frag}{slashes}",
                 st.sampled_from(["http://", "https://", "HTTPS://", ""]), st.sampled_from(["", "www.", "WWW."]),
                 _host, st.from_regex(r"(/[A-Za-z0-9_-]{1,6}){0,3}", fullmatch=True),
                 st.sampled_from(["", "?utm_source=rss", "?a=1&b=2"]), st.sampled_from(["", "#top"]),
                 st.sampled_from(["", "/", "//"]))


def _norm_model(u: str) -> str:
    import re
    x = u.lower()
    x = re.sub(r"^https?://(www\.)?", "", x)
    x = re.sub(r"[?#].*$", "", x)
    return re.sub(r"/+$", "", x)


@settings(**SETTINGS)
@given(st.lists(_url, min_size=1, max_size=40))
def test_url_normalisation_model_and_idempotence(spark, urls):
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    rows = df.select(normalise_campaign_url("u").alias("a"),
                     normalise_campaign_url(normalise_campaign_url("u")).alias("b")).collect()
    assert [r.a for r in rows] == [_norm_model(u) for u in urls]
    assert all(r.a == r.b for r in rows)


# A model of the documented IOC extraction, written independently of the Spark version.
def _first(d, keys):
    for k in keys:
        v = d.get(k)
        if v not in (None, ""):
            return str(v)
    return None


def _ioc_model(raw):
    if raw is None or raw.strip() == "":
        return []
    try:
        val = json.loads(raw)
    except ValueError:
        return [(None, raw, None)]
    if isinstance(val, dict):
        val = [val]
    if not isinstance(val, list):
        return []
    out = []
    for item in val:
        if isinstance(item, dict):
            out.append((_first(item, ["type", "ioc_type", "indicator_type"]),
                        _first(item, ["value", "indicator", "ioc", "observable"]),
                        _first(item, ["context", "note", "description"])))
        else:
            out.append((None, item if isinstance(item, str) else json.dumps(item, separators=(",", ":")), None))
    return out


_word = st.from_regex(r"[a-z0-9.-]{1,10}", fullmatch=True)
_obj = st.dictionaries(st.sampled_from(["type", "ioc_type", "indicator_type", "value", "indicator", "ioc",
                                        "observable", "context", "note", "description"]),
                       st.one_of(_word, st.just("")), max_size=5)
_raw = st.one_of(
    st.none(), st.just(""), _word,
    st.builds(json.dumps, _obj),
    st.builds(json.dumps, st.lists(st.one_of(_obj, _word), max_size=4)),
)


@settings(**SETTINGS)
@given(st.lists(_raw, min_size=1, max_size=30))
def test_ioc_normalisation_matches_model(spark, raws):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, k string")
    rows = (df.select("i", F.posexplode(F.transform(ioc_elements("k"), ioc_struct)).alias("p", "x"))
            .select("i", "p", "x.ioc_type", "x.ioc_value", "x.context").orderBy("i", "p").collect())
    got = {}
    for r in rows:
        got.setdefault(r.i, []).append((r.ioc_type, r.ioc_value, r.context))
    for i, raw in enumerate(raws):
        assert got.get(i, []) == _ioc_model(raw), raw


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 50), st.text("xyz", max_size=3)),
                min_size=1, max_size=60, unique_by=lambda t: (t[0], t[1])))
def test_first_and_last_write_models(spark, versions):
    df = spark.createDataFrame([(k, "f", n, v) for k, n, v in versions], "guid string, feed_url string, n int, v string")
    keys = ["guid", "feed_url"]
    cur = {r.guid: (r.n, r.v) for r in tbl.upsert_latest(df.where(F.lit(False)), df, keys, ["n"]).collect()}
    first = {r.guid: (r.n, r.v) for r in tbl.append_new(df.where(F.lit(False)), df, keys, ["n"]).collect()}
    by_key = {}
    for k, n, v in versions:
        by_key.setdefault(k, []).append((n, v))
    assert cur == {k: max(vs) for k, vs in by_key.items()}
    assert first == {k: min(vs) for k, vs in by_key.items()}
