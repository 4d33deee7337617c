"""Names, patterns and tables that results depend on literally."""

# Identifiers that may not be used as column names.
RESERVED_WORDS = (
    "ACCESS", "ADD", "ALL", "ALTER", "AND", "ANY", "AS", "ASC", "AUDIT", "BETWEEN", "BY", "CHAR", "CHECK",
    "CLUSTER", "COLUMN", "COMMENT", "COMPRESS", "CONNECT", "COUNT", "CREATE", "CURRENT", "DATE", "DECIMAL",
    "DEFAULT", "DELETE", "DESC", "DISTINCT", "DROP", "ELSE", "EXCLUSIVE", "EXISTS", "FILE", "FLOAT", "FOR",
    "FROM", "GRANT", "GROUP", "HAVING", "IDENTIFIED", "IMMEDIATE", "IN", "INCREMENT", "INDEX", "INITIAL",
    "INSERT", "INTEGER", "INTERSECT", "INTO", "IS", "LEVEL", "LIKE", "LOCK", "LONG", "MAXEXTENTS", "MINUS",
    "MLSLABEL", "MODE", "MODIFY", "NOAUDIT", "NOCOMPRESS", "NOT", "NOWAIT", "NULL", "NUMBER", "OF", "OFFLINE",
    "ON", "ONLINE", "OPTION", "OR", "ORDER", "PCTFREE", "PRIOR", "PRIVILEGES", "PUBLIC", "RAW", "RENAME",
    "RESOURCE", "REVOKE", "ROW", "ROWID", "ROWNUM", "ROWS", "SELECT", "SESSION", "SET", "SHARE", "SIZE",
    "SMALLINT", "START", "SUCCESSFUL", "SYNONYM", "SYSDATE", "TABLE", "THEN", "TO", "TRIGGER", "UID", "UNION",
    "UNIQUE", "UPDATE", "USER", "VALIDATE", "VALUES", "VARCHAR", "VARCHAR2", "VIEW", "WHENEVER", "WHERE",
    "WITH", "CROSS", "CUBE", "FETCH", "FULL", "INNER", "JOIN", "LEFT", "MERGE", "NATURAL", "OFFSET", "OUTER",
    "RIGHT", "ROLLUP", "USING", "WHEN", "CASE",
)

# Object names and name endings left out of a migration.
SKIPPED_ENDINGS = ("__History", "__Feed", "__Share", "__Tag", "__ChangeEvent", "__e", "__mdt", "__b")
SKIPPED_OBJECTS = (
    "AccountFeed", "ContactFeed", "CaseFeed", "LeadFeed", "OpportunityFeed", "UserFeed",
    "CollaborationGroupFeed", "AccountHistory", "ContactHistory", "CaseHistory", "LeadHistory",
    "OpportunityHistory", "OpportunityFieldHistory", "AccountShare", "CaseShare", "LeadShare",
    "OpportunityShare", "ApexClass", "ApexTrigger", "ApexLog", "ApexTestResult", "AsyncApexJob", "CronTrigger",
    "CronJobDetail", "ContentVersion", "ContentDocument", "ContentDocumentLink", "ContentFolderItem",
    "IdeaComment", "EntityDefinition", "FieldDefinition", "FieldPermissions", "OauthToken", "AuthSession",
    "SessionPermSetActivation", "TwoFactorInfo", "VerificationHistory", "LoginHistory", "LoginGeo",
    "StaticResource", "AuraDefinition", "AuraDefinitionBundle", "FlowDefinitionView", "FlowInterview",
    "PlatformEventChannel", "PlatformEventChannelMember", "DataStatistics", "BackgroundOperation",
    "SetupAuditTrail", "PermissionSet", "PermissionSetAssignment", "GroupMember", "UserRole", "UserLicense",
)

# Social security numbers, labelled, separated or bare.
SSN_PATTERN = (
    r"(?i)(?:"
    r"(?:SSN|S\.S\.N\.?|Social\s+Security(?:\s+Number)?|SS#|SSN#)\s*[:#]?\s*\d{3}[-\s.]?\d{2}[-\s.]?\d{4}"
    r"|\b\d{3}[-\s.]\d{2}[-\s.]\d{4}\b"
    r"|\b\d{9}\b"
    r")"
)
REDACTED = "[REDACTED]"

# The ten ledger fields and the pieces of a ledger line.
LEDGER_HEADER = (
    "Transaction Date",
    "Transaction Amount",
    "Due Date",
    "Description",
    "Principal Amount",
    "Interest Amount",
    "Escrow Amount",
    "Late Charge Amount",
    "Principal Balance",
    "Escrow Balance",
)
LEDGER_DATE = r"\d{1,2}/\d{1,2}/\d{2,4}"
LEDGER_MONEY = r"-?\$?\d{1,3}(?:,\d{3})*\.\d{2}|-?\$?\d+\.\d{2}"
LEDGER_GAP = r"(?:\t+|\s{2,})"

# Text length limits of the relational target.
MAX_TEXT_LENGTH = 4000
LENGTH_HEADROOM = 50

# Words read as true in text.
TRUE_WORDS = ("true", "1", "yes", "on")
