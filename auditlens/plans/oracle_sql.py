"""Key -> DuckDB SQL for the registered queries."""

from auditlens.plans import oracle as O


def oracle_sql() -> dict[str, str]:
    from auditlens.plans import windowed

    whole = _whole()
    return whole | windowed.oracle_sql(whole)


def _whole() -> dict[str, str]:
    from auditlens.plans import windowed

    return {
        "bronze": O.bronze_sql(),
        "audit_parse": O.audit_parse_sql(),
        "conn_parse": O.conn_parse_sql(),
        "session_info": O.session_info_sql(),
        "session_enrich": O.session_enrich_sql(),
        "session_asof": O.session_asof_sql(),
        "exfiltration": O.exfiltration_sql(),
        "destructive_ops": O.destructive_ops_sql(),
        "error_spike": O.error_spike_sql(),
        "privilege_escalation": O.privilege_escalation_sql(),
        "cross_schema_recon": O.cross_schema_recon_sql(),
        "deep_schema_enum": O.deep_schema_enum_sql(),
        "brute_force": O.brute_force_sql(),
        "brute_force_by_code": O.brute_force_by_code_sql(),
        "error_spike_5m": O.error_spike_5m_sql(),
        "exfiltration_by_user": O.exfiltration_by_user_sql(),
        "quick_exfil": O.quick_exfil_sql(),
        "quick_destructive": O.quick_destructive_sql(),
        "quick_errors": O.quick_errors_sql(),
        "quick_privilege": O.quick_privilege_sql(),
        "anomalies_all": O.anomalies_all_sql(),
        "security_kpis": O.security_kpis_sql(),
        "anomaly_details": O.anomaly_details_sql(),
        "condition_alerts": O.condition_alerts_sql(),
        "activity_rollup_hour": O.activity_rollup_sql("hour"),
        "activity_rollup_day": O.activity_rollup_sql("day"),
        "backend_sessions": O.backend_sessions_sql(),
        "backend_sessions_stream": O.backend_sessions_sql(),
        "recent_errors_sql": O.recent_errors_sql(),
        "alert_rules": O.alert_rules_sql(),
        "metric_stream": O.activity_metrics_sql(),
        "error_metric_stream": O.error_metrics_sql(),
        "error_spike_stream": O.error_spike_sql(),
        "destructive_ops_stream": O.destructive_ops_sql(),
        "privilege_escalation_stream": O.privilege_escalation_sql(),
        "exfiltration_stream": O.exfiltration_sql(),
        "cross_schema_recon_stream": O.cross_schema_recon_sql(),
        "deep_schema_enum_stream": O.deep_schema_enum_sql(),
        "brute_force_stream": O.brute_force_sql(),
        "user_metric_stream": O.user_metrics_sql(),
        "destructive_ops_live": O.destructive_ops_live_sql(),
        "privilege_escalation_live": O.privilege_escalation_live_sql(),
        "session_enrich_stream": O.session_enrich_stream_sql(),
        "quick_all": O.quick_all_sql(),
        "auth_error_diagnostics": O.auth_error_diagnostics_sql(),
        "audit_timeline_6way": O.audit_timeline_sql(include_misc=False),
        "cross_schema_recon_literal": O.cross_schema_recon_sql(literal=True),
        "alert_stream": O.alert_stream_sql(ml=True),
        "baseline_model": O.baseline_model_sql(),
        "activity_series": O.activity_series_sql(),
        "series_expanded": O.series_expanded_sql(),
        "session_table": O.session_info_sql(),
        "session_table_window": windowed.cut_log(O.session_info_sql(), "24h"),
        "anomaly_details_stored": O.anomaly_details_sql(),
        "stream_health": O.stream_health_sql(),
        "exfiltration_by_message_user": O.exfiltration_by_message_user_sql(),
        "alert_once_stream": O.alert_once_stream_sql(),
        "alert_burst_stream": O.alert_burst_stream_sql(),
        "ingest_stream": O.bronze_sql(),
        "backfill_resumed": O.activity_metrics_sql(),
        "error_backfill": O.error_metrics_sql(),
        "user_backfill": O.user_metrics_sql(),
        "ddl_offhours": O.privilege_offhours_sql("DDLOps"),
        "activity_metrics": O.activity_metrics_sql(),
        "activity_backfill": O.activity_metrics_sql(),
        "error_metrics": O.error_metrics_sql(),
        "user_metrics": O.user_metrics_sql(),
        "privilege_offhours": O.privilege_offhours_sql(),
        "baseline_deviation": O.baseline_deviation_sql(),
        "baseline_deviation_pct": O.baseline_deviation_pct_sql(),
        "metrics_latest": O.metrics_latest_sql(),
        "metrics_stats": O.metrics_stats_sql(),
        "metrics_status": O.metrics_status_sql(),
        "history_depth": O.history_depth_sql(),
        "hourly_profile": O.hourly_profile_sql(),
        "data_freshness": O.data_freshness_sql(),
        "active_users_today": O.active_users_today_sql(),
        "activity_by_server": O.activity_by_server_sql(),
        "audit_distribution": O.audit_distribution_sql(),
        "top_tables": O.top_tables_sql(),
        "audit_timeline": O.audit_timeline_sql(),
        "errors_by_category": O.errors_by_category_sql(),
        "activity_by_backend": O.activity_by_backend_sql(),
        "top_users": O.top_users_sql(),
        "top_hosts": O.top_hosts_sql(),
        "user_db_heatmap": O.user_db_heatmap_sql(),
        "auth_failures": O.auth_failures_sql(),
        "top_error_codes": O.top_error_codes_sql(),
        "audit_coverage": O.audit_coverage_sql(),
        "backend_distribution": O.backend_distribution_sql(),
        "error_code_diagnostics": O.error_code_diagnostics_sql(),
        "privilege_ops_by_user": O.privilege_ops_by_user_sql(),
        "errors_per_minute": O.errors_per_minute_sql(),
        "connection_sample": O.connection_sample_sql(),
        "current_activity": O.current_activity_sql(),
    }
