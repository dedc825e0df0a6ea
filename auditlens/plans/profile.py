"""Parameters the registered queries run with ("history hunt" profile).

The driver's tables hold 30 days of traffic at a few events per hour per
server, so the reference's 1-15 minute windows would almost never fire.
The registered queries therefore scan the WHOLE history (no lookback)
and, for the detectors, widen only the window: the thresholds stay the
reference's. Dashboard tiles keep the reference's bins. The true windows
and thresholds are the functions' defaults and are covered by the pytest
scenarios.

The registered streaming queries replay the stored log through Structured
Streaming with the same thresholds and a 10-minute watermark. The log lands in two
steps, between which every query is stopped and resumed from its checkpoint; a
heartbeat after its end closes the last windows. The detectors' state is
read in the windows of the batch queries; alert rules use one-day windows.
"""

from auditlens.operators.alerts import RULES

HUNT = {
    "exfiltration": dict(lookback=None, session_lookback=None, bucket=None),
    "destructive_ops": dict(lookback=None, session_lookback=None, bucket="1d"),
    "error_spike": dict(lookback=None, session_lookback=None, bucket="1d"),
    "privilege_escalation": dict(lookback=None, session_lookback=None, bucket="1d"),
    "cross_schema_recon": dict(lookback=None, session_lookback=None, bucket=None),
    "deep_schema_enum": dict(lookback=None, session_lookback=None, bucket=None),
    "brute_force": dict(lookback=None),
    "brute_force_by_code": dict(lookback=None),
    "error_spike_5m": dict(lookback=None, bucket="1d"),
    "exfiltration_by_user": dict(lookback=None, session_lookback=None),
    "quick_exfil": dict(lookback=None, session_lookback=None, bucket=None),
    "quick_destructive": dict(lookback=None, session_lookback=None, bucket="1d"),
    "quick_errors": dict(lookback=None, session_lookback=None, bucket="1d"),
    "quick_privilege": dict(lookback=None, session_lookback=None, bucket="1d"),
}

DAY = 86400

#: The rule table of ``alert_stream``: scores of these tables stay below the ML rule's 3.0, so
#: there it fires from the detection threshold on.
HUNT_RULES = [(*r[:3], 1.5, *r[4:]) if r[0] == "ML Anomaly" else r for r in RULES]
