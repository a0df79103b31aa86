"""The lenient decoder against plain Python: parse, take the fields, ``int(label)``, drop on any error."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fleetlake.functions.decode import decode_lenient

TEXT = st.text(alphabet=' 0123456789+-.eE"\\{}[]:,abN\n\té가', max_size=6)
VALUE = st.one_of(
    st.none(), st.booleans(), st.integers(-(2**31), 2**31 - 1), st.integers(), st.floats(), TEXT,
    st.lists(st.integers(), max_size=2), st.dictionaries(TEXT, st.integers(), max_size=2),
)
OBJECT = st.fixed_dictionaries({}, optional={"label": VALUE, "machine": TEXT, "col_0": VALUE, "x": VALUE, "label ": VALUE})


@st.composite
def payloads(draw):
    text = json.dumps(draw(st.one_of(OBJECT, OBJECT, OBJECT, VALUE)), ensure_ascii=draw(st.booleans()))
    harm = draw(st.integers(0, 9))
    if harm == 0:
        return text[: draw(st.integers(0, len(text)))]
    if harm == 1:
        return text + draw(TEXT)
    return text




def expected(payload):
    try:
        message = json.loads(payload)
        label = int(message.get("label", 0))
    except Exception:
        return None
    return (label, message.get("machine")) if -(2**31) <= label < 2**31 else None


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(batch=st.lists(payloads(), min_size=60, max_size=120))
def test_lenient_equals_python(messages, batch):
    rows = {row.offset: (row.label, row.machine) for row in decode_lenient(messages(batch), keep=["offset"]).collect()}
    for i, payload in enumerate(batch):
        assert rows.get(i) == expected(payload), payload


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.one_of(st.floats(), st.integers(-(2**60), 2**60)), min_size=40, max_size=80))
def test_lenient_metrics_equal_python(messages, values):
    texts = [json.dumps({"col_0": v, "col_1": json.dumps(v), "col_2": v}) for v in values]
    for quoted in (True, False):
        batch = texts if quoted else [t.replace("col_1", "y") for t in texts]
        rows = decode_lenient(messages(batch), keep=["offset"]).collect()
        assert len(rows) == len(values)
        for row in rows:
            value = float(values[row.offset])
            found = (row.col_0, row.col_1, row.col_2) if quoted else (row.col_0, row.col_2)
            assert {str(v) for v in found} == {str(value)}
