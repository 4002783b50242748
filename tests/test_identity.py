from datetime import datetime

from accountpulse.operators import identity

JAN, FEB = datetime(2026, 1, 31, 23), datetime(2026, 2, 1)


def steps(frame):
    return frame(
        "biometricId STRING, stepName STRING, status STRING, description STRING, documentCheckId STRING, "
        "livenessId STRING, facematchId STRING, createdAt TIMESTAMP_NTZ",
        [
            ("s1", "document_check", "Approved", None, "d1", None, None, JAN),
            ("s1", "document_check", "Failed", None, "d1", None, None, JAN),
            ("s1", "liveness", "Fraud", None, None, "l1", None, JAN),
            ("s1", "liveness", "Approved", "Se detecto FRAUDE", None, "gone", None, JAN),
            ("s1", "liveness", "Approved", None, None, None, None, JAN),
            ("s1", "facematch", "Approved", None, None, None, "f1", FEB),
            ("s2", "facematch", "Approved", None, None, None, "f2", FEB),
            ("s2", "document_check", "Rejected", None, "d2", None, None, FEB),
            ("gone", "liveness", "Approved", "fraude", None, None, None, FEB),
            (None, "liveness", "Approved", None, None, None, None, FEB),
        ],
    )


def sessions(frame):
    return frame(
        "id STRING, companyId INT, status STRING, details STRING, createdAt TIMESTAMP_NTZ",
        [
            ("s1", 1, "Approved", '{"skill_id": "k1", "execution_id": "e1"}', JAN),
            ("s2", 1, "Abandoned", '{"skill_id": 7}', FEB),
            ("s3", None, "Initiated", "no json", FEB),
        ],
    )


def checks(frame):
    return frame(
        "id STRING, entityResponse INT, documentIdentityId STRING", [("d1", 1, "i1"), ("d2", None, None)]
    )


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_monthly_counts(frame):
    assert got(identity.kyc_sessions_monthly(sessions(frame), "2026-01-01")) == [
        ("2026-01", "Approved", 1),
        ("2026-02", "Abandoned", 1),
        ("2026-02", "Initiated", 1),
    ]
    assert ("2026-01", "liveness", "Approved", 2) in got(identity.kyc_steps_monthly(steps(frame)))
    assert got(identity.gov_validation_monthly(steps(frame), checks(frame))) == [
        ("2026-01", 1, 2),
        ("2026-02", None, 1),
    ]
    assert got(identity.kyc_steps_monthly(steps(frame), "2026-02-01"))[0][0] == "2026-02"


def test_signatures(frame):
    df = frame("provider STRING, status STRING, createdAt TIMESTAMP_NTZ", [("FAD", "Sent", JAN), ("FAD", "Sent", JAN)])
    assert got(identity.signatures_monthly(df)) == [("2026-01", "FAD", "Sent", 2)]


def test_volume_and_approval(frame):
    assert got(identity.kyc_volume_by_company(sessions(frame))) == [(1, "2026-01", 1), (1, "2026-02", 1)]
    assert got(identity.kyc_approval_rate(sessions(frame))) == [("2026-01", 1, 1, 1.0), ("2026-02", 2, 0, 0.0)]


def test_funnel(frame):
    assert {r[0]: tuple(r)[1:] for r in identity.kyc_funnel(sessions(frame), steps(frame)).collect()} == {
        "session": (3, 1),
        "not_completed": (2, 0),
        "document_check": (2, 1),
        "liveness": (1, 1),
        "facematch": (2, 2),
    }


def test_fraud_rate(frame):
    assert got(identity.liveness_fraud_rate(steps(frame))) == [("2026-01", 3, 2, 2 / 3), ("2026-02", 2, 1, 0.5)]
    bare = steps(frame).drop("description")
    assert got(identity.liveness_fraud_rate(bare, "2026-02-01")) == [("2026-02", 2, 0, 0.0)]


def test_facematch_scores(frame):
    scores = frame("id STRING, similarity INT", [("f1", 90), ("f2", 100), ("f3", 1)])
    assert got(identity.facematch_scores(steps(frame), scores)) == [("2026-02", 2, 95.0, 92.5, 95.0, 97.5)]


def test_countries_and_security(frame):
    docs = frame(
        "clientId STRING, country STRING, nationality STRING",
        [("c1", "EC", "EC"), ("c1", "EC", "EC"), ("c2", "EC", "EC"), (None, "EC", "EC"), ("c1", None, "CO")],
    )
    assert got(identity.identity_countries(docs)) == [("EC", "EC", 4, 2), (None, "CO", 1, 1)]
    events = frame(
        "type STRING, severity STRING, resolved INT", [("M", "HIGH", 0), ("M", "HIGH", 1), ("M", "HIGH", None)]
    )
    assert got(identity.security_events_summary(events)) == [("M", "HIGH", 3, 1)]


def test_enriched_keeps_every_step_once(frame):
    out = identity.steps_enriched(
        steps(frame),
        sessions(frame),
        checks(frame),
        frame("id STRING, country STRING", [("i1", "EC")]),
        frame("id STRING, otpCode STRING", [("l1", "uno")]),
        frame("id STRING, similarity INT", [("f1", 99)]),
    )
    rows = out.collect()
    assert len(rows) == 10
    by = {(r.biometricId, r.stepName, r.status, r.description): r for r in rows}
    doc = by[("s1", "document_check", "Approved", None)]
    assert (doc.session_companyId, doc.document_check_entityResponse, doc.identity_country) == (1, 1, "EC")
    assert by[("s1", "liveness", "Fraud", None)].liveness_otpCode == "uno"
    assert by[("s1", "liveness", "Approved", "Se detecto FRAUDE")].liveness_otpCode is None
    assert by[("s1", "facematch", "Approved", None)].facematch_similarity == 99
    assert by[("gone", "liveness", "Approved", "fraude")].session_status is None
    assert by[(None, "liveness", "Approved", None)].session_status is None


def test_workflow_context(frame):
    runs = frame("executionId STRING, flow STRING", [("e1", "main"), ("e2", "other")])
    out = {r.id: r for r in identity.kyc_workflow_context(sessions(frame), runs).collect()}
    assert (out["s1"].skill_id, out["s1"].execution_id, out["s1"].flow) == ("k1", "e1", "main")
    assert (out["s2"].skill_id, out["s2"].execution_id, out["s2"].flow) == ("7", None, None)
    assert out["s3"].skill_id is None and out["s3"].flow is None
