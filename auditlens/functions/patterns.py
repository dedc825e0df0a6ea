"""Message formats: extraction patterns and term lists.

Fixed values. These must equal the reference's patterns and lists for the
same rows to be parsed and flagged; they are stated here once, in the
order the reference uses them.
"""

# ---- fixed values: extraction patterns (group 1 is the field) ----------
USER_RE = r"user=([^\s,]+)"
DATABASE_RE = r"database=([^\s,]+)"
HOST_RE = r"host=([^\s]+)"
AUDIT_CLASS_RE = r"AUDIT: SESSION,\d+,\d+,([A-Z]+),"
AUDIT_STATEMENT_RE = r"AUDIT: SESSION,\d+,\d+,[A-Z]+,([A-Z ]+),"
AUDIT_OBJECT_TYPE_RE = r"AUDIT: SESSION,\d+,\d+,[A-Z]+,[A-Z ]+,([^,]*),"
AUDIT_OBJECT_NAME_RE = r"AUDIT: SESSION,\d+,\d+,[A-Z]+,[A-Z ]+,[^,]*,([^,<]*)"
AUDIT_SCHEMA_RE = r"AUDIT: SESSION,\d+,\d+,[A-Z]+,[A-Z ]+,([^\.]+)\."
QUERY_TEXT_RE = r",,,([^<]+)<"
STATEMENT_TEXT_RE = r"statement: (.+)$"
SCHEMA_PREFIX_RE = r"^([^\.]+)\."

# ---- fixed values: marker texts (case-insensitive substring tests) -----
AUDIT_MARK = "AUDIT:"
CONN_AUTHORIZED = "connection authorized"
CONN_RECEIVED = "connection received"

# ---- fixed values: levels, codes, users --------------------------------
ERROR_LEVELS = ("ERROR", "FATAL", "PANIC")
ERROR_LEVELS_NO_PANIC = ("ERROR", "FATAL")
OK_CODE = "00000"
SYSTEM_USERS = ("azuresu", "azure_maintenance")
SUPERUSER = "azuresu"
UNKNOWN = "UNKNOWN"
CLIENT_BACKEND = "client backend"
CATALOG_SCHEMAS = ("pg_catalog", "information_schema")

# ---- fixed values: has_any term lists ----------------------------------
ACTIVITY_SELECT_TERMS = ("SELECT", "COPY", ",READ,")
ACTIVITY_WRITE_TERMS = ("INSERT", "UPDATE", "DELETE", ",WRITE,")
ACTIVITY_DDL_TERMS = ("CREATE", "DROP", "ALTER TABLE", "ALTER INDEX")
ACTIVITY_PRIVILEGE_TERMS = ("GRANT", "REVOKE", "ALTER ROLE", "CREATE ROLE")
USER_SELECT_TERMS = ("SELECT", "COPY")
USER_DESTRUCTIVE_TERMS = ("DELETE", "UPDATE", "TRUNCATE", "DROP")
EXFIL_TERMS = ("SELECT", "COPY", "pg_dump")
DESTRUCTIVE_PREFILTER_TERMS = ("DELETE", "UPDATE", "TRUNCATE", "DROP TABLE", "DROP DATABASE")
DESTRUCTIVE_TERMS = ("DELETE", "UPDATE", "TRUNCATE", "DROP")
PRIVILEGE_TERMS = ("GRANT", "REVOKE", "ALTER ROLE", "CREATE ROLE", "DROP ROLE")
PRIVILEGE_ALERT_TERMS = ("GRANT", "REVOKE", "ALTER ROLE", "CREATE ROLE", "DROP ROLE", "anomaly_test")
CATALOG_TERMS = ("pg_catalog", "information_schema", "pg_tables", "pg_class",
                 "pg_attribute", "pg_proc", "pg_type", "pg_constraint", "pg_roles", "pg_indexes",
                 "table_constraints", "table_privileges", "routines")

# ---- fixed values: case() label tables, first match wins ---------------
# (kind, needle(s), label); kind "msg" = message contains any needle,
# "code" = sqlerrcode starts with the needle.
ERROR_METRIC_CATEGORIES = (
    ("msg", ("authentication", "password"), "Authentication"),
    ("msg", ("permission denied",), "Permission"),
    ("msg", ("connection",), "Connection"),
)
ERROR_METRIC_DEFAULT = "Other"

ERROR_SPIKE_CATEGORIES = (
    ("msg", ("authentication", "password"), "Authentication Failure"),
    ("msg", ("permission denied", "access denied"), "Permission Denied"),
    ("msg", ("connection", "timeout"), "Connection Error"),
    ("code", "28", "Authorization Error"),
    ("code", "42", "Permission Error"),
    ("code", "08", "Connection Error"),
    ("code", "53", "Resource Error"),
    ("code", "57", "Operator Intervention"),
)
ERROR_SPIKE_DEFAULT = "Other Error"

ERROR_DASHBOARD_CATEGORIES = (
    ("msg", ("authentication",), "Auth Errors"),
    ("msg", ("permission",), "Permission Errors"),
    ("msg", ("connection",), "Connection Errors"),
    ("code", "28", "Auth Errors"),
    ("code", "42", "Permission Errors"),
    ("code", "08", "Connection Errors"),
    ("code", "53", "Resource Errors"),
)
ERROR_DASHBOARD_DEFAULT = "Other Errors"

ERROR_5M_CATEGORIES = (
    ("msg", ("authentication",), "Auth Error"),
    ("msg", ("permission denied",), "Permission Error"),
    ("msg", ("connection",), "Connection Error"),
    ("code", "28", "Auth Error"),
    ("code", "42", "Permission Error"),
    ("code", "53", "Resource Error"),
)
ERROR_5M_DEFAULT = "Other Error"

ERROR_CODE_CLASSES = (
    ("code", "28", "Auth/Authorization"),
    ("code", "42", "Syntax/Permission"),
    ("code", "08", "Connection Exception"),
    ("code", "53", "Insufficient Resources"),
    ("code", "57", "Operator Intervention"),
    ("code", "23", "Integrity Violation"),
)
ERROR_CODE_DEFAULT = "Other"

PRIVILEGE_OPS = (
    ("msg", ("CREATE ROLE",), "CREATE ROLE"),
    ("msg", ("DROP ROLE",), "DROP ROLE"),
    ("msg", ("GRANT",), "GRANT"),
    ("msg", ("REVOKE",), "REVOKE"),
    ("msg", ("ALTER ROLE",), "ALTER ROLE"),
)
PRIVILEGE_OPS_DEFAULT = "ROLE_RELATED"

SYSTEM_TABLES = (
    ("msg", ("pg_tables",), "pg_tables"),
    ("msg", ("pg_class",), "pg_class"),
    ("msg", ("pg_attribute",), "pg_attribute"),
    ("msg", ("pg_proc",), "pg_proc"),
    ("msg", ("pg_type",), "pg_type"),
    ("msg", ("pg_constraint",), "pg_constraint"),
    ("msg", ("pg_roles",), "pg_roles"),
    ("msg", ("pg_indexes",), "pg_indexes"),
    ("msg", ("information_schema.tables",), "info_tables"),
    ("msg", ("information_schema.columns",), "info_columns"),
    ("msg", ("information_schema.routines",), "info_routines"),
)
SYSTEM_TABLES_DEFAULT = "other_system"

AUDIT_OPERATION_TYPES = (
    ("msg", (",READ,", ",SELECT,"), "SELECT"),
    ("msg", (",WRITE,", ",UPDATE,"), "WRITE"),
    ("msg", (",DELETE,",), "DELETE"),
    ("msg", (",INSERT,",), "INSERT"),
    ("msg", (",DDL,",), "DDL"),
    ("msg", (",MISC,",), "MISC"),
)
AUDIT_OPERATION_DEFAULT = "OTHER"
