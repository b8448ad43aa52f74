"""Log lines, tokens, addresses, redaction and search over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadloom.functions import text as T
from broadloom.session import table
from broadloom.sources.views import LOG_SQL, log_lines


def parse_android_log(spark, sf_dir):
    return T.parse_log(log_lines(table(spark, sf_dir, "events")))


def classify_url(spark, sf_dir):
    """Hosts of pages, and addresses made of part names, as kinds; then a count per kind."""
    urls = table(spark, sf_dir, "pages").select("url").unionByName(_addresses(table(spark, sf_dir, "part")))
    return urls.groupBy(T.classify_url(F.col("url")).alias("kind")).agg(F.count("*").alias("n"))


_HOSTS = ["10.0.0.1:80/a", "x.duckdns.org", "bit.ly/q", "www.w3.org/ns", "media.admob.com", "api.mixpanel.com", "maps.google.com", "own.example.org"]


def _addresses(part):
    i = (F.col("p_partkey") % len(_HOSTS) + 1).cast("int")
    return part.select(F.concat(F.element_at(F.array(*[F.lit(h) for h in _HOSTS]), i), F.lit("/"), F.col("p_partkey").cast("string")).alias("url"))


_ADDRESSES = "SELECT [" + ", ".join(f"'{h}'" for h in _HOSTS) + f"][p_partkey % {len(_HOSTS)} + 1] || '/' || CAST(p_partkey AS VARCHAR) AS url FROM part"

_NAMES = [
    ".MainActivity", "androidx.core.App", "com.facebook.Login", "com.acme.AdActivity", ".PushService", "com.acme.BillingService", ".BootReceiver", ".SmsReceiver", ".DeviceAdmin",
    "com.acme.Accessibility", ".WallpaperService", ".UpdateService", ".LockScreen", ".NotifyService", ".VideoPlayer", ".Zq", "com.acme.Zq",
]
_PERMISSIONS = ["android.permission.INTERNET", "android.permission.SEND_SMS", "com.acme.permission.C2D_MESSAGE", "com.acme.JPUSH", "android.permission.GET_ACCOUNTS", "com.acme.READ_MEDIA", "com.android.vending.BILLING", "com.acme.THING"]
_INTENTS = ["", "android.intent.action.MAIN", "android.intent.action.BOOT_COMPLETED", "com.acme.SMS", "com.acme.PACKAGE", "android.net.wifi.STATE", "android.intent.extra.X", "com.acme.ACTION"]
_HARDWARE = ["android.hardware.camera", "android.hardware.telephony", "android.hardware.location.gps", "android.hardware.touchscreen", "android.hardware.sensor.light", "android.hardware.screen.portrait", "android.software.vr.mode", "android.hardware.other"]
_APIS = ["Landroid/telephony/SmsManager;->sendTextMessage", "android.location.LocationManager.getLastKnownLocation", "Ljava/lang/Runtime;->exec", "com.acme.Thing.run"]


def _tokens(part, words: list[str], name: str = "item"):
    """One token per part, from a list by key."""
    i = (F.col("p_partkey") % len(words) + 1).cast("int")
    return part.select("p_partkey", F.element_at(F.array(*[F.lit(w) for w in words]), i).alias(name))


def _tokens_sql(words: list[str], name: str = "item") -> str:
    return "tok AS (SELECT p_partkey, [" + ", ".join(f"'{w}'" for w in words) + f"][p_partkey % {len(words)} + 1] AS {name} FROM part)"


def _known(spark, rows):
    return spark.createDataFrame(rows, "token string, label string")


def _rules_sql(x: str, rules, other: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({x}, '(?i){p}') THEN '{label}'" for p, label in rules) + f" ELSE {other} END"


def classify_component(spark, sf_dir):
    tokens = _tokens(table(spark, sf_dir, "part"), _NAMES)
    return tokens.groupBy(T.classify_component(F.col("item")).alias("class")).agg(F.count("*").alias("n"))


def classify_permission(spark, sf_dir):
    known = _known(spark, [("INTERNET", "network"), ("SEND_SMS", "premium_sms")])
    return T.classify_permission(_tokens(table(spark, sf_dir, "part"), _PERMISSIONS), known).groupBy("class", "vendor").agg(F.count("*").alias("n"))


def classify_intent(spark, sf_dir):
    known = _known(spark, [("android.intent.action.MAIN", "entry_point")])
    return T.classify_intent(_tokens(table(spark, sf_dir, "part"), _INTENTS), known).groupBy("class").agg(F.count("*").alias("n"))


def classify_hardware(spark, sf_dir):
    return _tokens(table(spark, sf_dir, "part"), _HARDWARE).groupBy(T.classify_hardware(F.col("item")).alias("class")).agg(F.count("*").alias("n"))


def classify_api(spark, sf_dir):
    classes = _known(spark, [("android.location.LocationManager", "location"), ("android.telephony.SmsManager", "telephony")])
    methods = _known(spark, [("sendTextMessage", "sends_sms"), ("exec", "runs_process")])
    return T.classify_api(_tokens(table(spark, sf_dir, "part"), _APIS), classes, methods).groupBy("api_class", "method", "class").agg(F.count("*").alias("n"))


_DISPATCH = ["RequestedPermissionList_android.permission.INTERNET", "UsedPermissionsList_android.hardware.camera", "ActivityList_.A_b", "URLDomainList_x.org", "IntentFilterList_", "SuspiciousApiList_a/b", "Other_x"]


def token_dispatch(spark, sf_dir):
    tokens = _tokens(table(spark, sf_dir, "part"), _DISPATCH, "token")
    return tokens.select(*[c.alias(n) for n, c in T.dispatch(F.col("token")).items()]).groupBy("category", "item", "route").agg(F.count("*").alias("n"))


def redact_secrets(spark, sf_dir):
    """Events with values of secret shapes: credentials, provider keys, and assignments in plain, quoted, JSON and escaped form."""
    i = F.col("event_id").cast("string")
    plain = F.concat(F.col("event_type"), F.lit(" Bearer abc.def-123 x ghp_" + "a" * 24 + " AKIA" + "B" * 16), F.lit(" "), i)
    parts = ["my.api_key=k", "; X-Auth-Token: \"a b ", "\", --password p", " {\"secrets\": {\"a\": [1, \"}\"], \"b\": ", "}, \"n\": 1} {\\\"client_secret\\\": \\\"q ", "\\\"} end"]
    assigned = F.concat(*[x for p in parts[:-1] for x in (F.lit(p), i)], F.lit(parts[-1]))
    text = F.when(F.col("event_id") % 2 == 0, plain).otherwise(assigned)
    return table(spark, sf_dir, "events").select("event_id", T.redact(text).alias("redacted"))


def redact_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.redact(F.col("text"), None).alias("redacted")).select("doc_id", F.length("redacted").alias("n_chars"), F.col("redacted").contains("<REDACTED>").alias("masked"))


def redact_map_keys(spark, sf_dir):
    json = F.to_json(F.struct(F.col("event_type").alias("kind"), F.col("user_id").cast("string").alias("api_key"), F.col("event_id").cast("string").alias("my.token.x")))
    m = T.redact_keys(json)
    return table(spark, sf_dir, "events").select("event_id", m["kind"].alias("kind"), m["api_key"].alias("api_key"), m["my.token.x"].alias("token"))


def redact_nested(spark, sf_dir):
    """Objects in objects, lists, and an object written as text inside another."""
    number, name = F.col("event_id").cast("string"), F.col("event_type")
    said = F.to_json(F.struct(number.alias("token"), name.alias("what"), F.array(F.struct(number.alias("client_secret"))).alias("deep")))
    listed = F.array(F.to_json(F.struct(number.alias("password"))), F.lit("Bearer abcdefgh1234"), name)
    inner = F.struct(F.struct(F.col("user_id").cast("string").alias("api_key"), F.col("event_id").alias("n")).alias("a"), listed.alias("list"))
    text = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("no json password="), number, F.lit("xyz"))).otherwise(F.to_json(F.struct(name.alias("kind"), inner.alias("inner"), said.alias("said"))))
    return table(spark, sf_dir, "events").select("event_id", T.redact_json(text).alias("redacted"))


def keyword_search(spark, sf_dir):
    return T.keyword_search(table(spark, sf_dir, "documents"), ["tion", "ung"], ["text", "source"], "doc_id", 20).select("doc_id", "source")


QUERIES = {f.__name__: f for f in [
    parse_android_log, classify_url, classify_component, classify_permission, classify_intent, classify_hardware, classify_api, token_dispatch, redact_secrets, redact_documents, redact_map_keys, redact_nested, keyword_search,
]}

_LOG = T.LOG_LINE.replace("'", "''")
_part = lambda i: f"CASE WHEN regexp_matches(raw_line, '{_LOG}') THEN regexp_extract(raw_line, '{_LOG}', {i}) END"
_words = lambda words: "|".join(w.replace(".", r"\.") for w in words)

SQL = {
    "parse_android_log": f"WITH {LOG_SQL} SELECT line_number, raw_line, {_part(1)} AS date, {_part(2)} AS time, TRY_CAST({_part(3)} AS INTEGER) AS pid, TRY_CAST({_part(4)} AS INTEGER) AS tid, {_part(5)} AS level, nullif(trim({_part(6)}), '') AS component, {_part(7)} AS content FROM lines",
    "classify_url": "WITH u AS (SELECT lower(url) AS x FROM (SELECT url FROM pages UNION ALL " + _ADDRESSES + r") t) SELECT CASE WHEN x IS NULL THEN NULL WHEN regexp_matches(split_part(x, '/', 1), '^\d{1,3}(\.\d{1,3}){3}(:\d+)?$') THEN 'ip' "
    + " ".join(f"WHEN regexp_matches(x, '{_words(w)}') THEN '{n}'" for w, n in ((T.DYNAMIC_DNS, "dynamic_dns"), (T.SHORTENERS, "shortener"), (T.NAMESPACES, "namespace"), (T.AD_NETWORKS, "advertising"), (T.ANALYTICS, "analytics"), (T.PLATFORMS, "platform")))
    + " ELSE 'other' END AS kind, count(*) AS n FROM u GROUP BY 1",
    "classify_component": f"WITH {_tokens_sql(_NAMES)} SELECT CASE " + " ".join(f"WHEN starts_with(item, '{p}') THEN '{n}'" for p, n in T.COMPONENT_PREFIXES) + " ELSE " + _rules_sql("item", T.COMPONENT_RULES, "CASE WHEN starts_with(item, '.') THEN 'app_local' ELSE 'third_party' END") + ' END AS "class", count(*) AS n FROM tok GROUP BY 1',
    "classify_permission": f"WITH {_tokens_sql(_PERMISSIONS)}, k AS (SELECT *, upper(split_part(item, '.', -1)) AS s FROM tok) SELECT CASE WHEN s = 'INTERNET' THEN 'network' WHEN s = 'SEND_SMS' THEN 'premium_sms' ELSE " + _rules_sql("item", T.PERMISSION_RULES, "'other'") + " END AS \"class\", NOT (starts_with(item, 'android.') OR starts_with(item, 'com.android.')) AS vendor, count(*) AS n FROM k GROUP BY 1, 2",
    "classify_intent": f"WITH {_tokens_sql(_INTENTS)} SELECT CASE WHEN item = '' THEN 'empty' WHEN item = 'android.intent.action.MAIN' THEN 'entry_point' ELSE " + _rules_sql("item", T.INTENT_RULES, "CASE WHEN starts_with(item, 'android.') THEN 'platform' ELSE 'custom' END") + ' END AS "class", count(*) AS n FROM tok GROUP BY 1',
    "classify_hardware": f"WITH {_tokens_sql(_HARDWARE)} SELECT {_rules_sql('item', T.HARDWARE_RULES, chr(39) + 'other' + chr(39))} AS \"class\", count(*) AS n FROM tok GROUP BY 1",
    "classify_api": f"""WITH {_tokens_sql(_APIS)}, t AS (SELECT replace(replace(regexp_replace(item, '^L+', ''), ';->', '.'), '/', '.') AS x FROM tok),
u AS (SELECT regexp_extract(x, '^(.*)\\.[^.]*$', 1) AS api_class, split_part(x, '.', -1) AS method FROM t)
SELECT api_class, method, CASE WHEN method = 'sendTextMessage' THEN 'sends_sms' WHEN method = 'exec' THEN 'runs_process' WHEN api_class = 'android.location.LocationManager' THEN 'location' WHEN api_class = 'android.telephony.SmsManager' THEN 'telephony' ELSE 'other' END AS "class", count(*) AS n FROM u GROUP BY 1, 2, 3""",
    "token_dispatch": f"""WITH {_tokens_sql(_DISPATCH, 'token')}, s AS (SELECT split_part(token, '_', 1) AS category, CASE WHEN contains(token, '_') THEN substr(token, strpos(token, '_') + 1) ELSE '' END AS item FROM tok)
SELECT category, item, CASE WHEN category IN ('RequestedPermissionList', 'UsedPermissionsList') THEN CASE WHEN starts_with(item, 'android.hardware.') OR starts_with(item, 'android.software.') THEN 'hardware' ELSE 'permission' END
 WHEN category = 'HardwareComponentsList' THEN 'hardware' WHEN category IN ('RestrictedApiList', 'SuspiciousApiList') THEN 'api' WHEN category = 'IntentFilterList' THEN 'intent'
 WHEN category IN ('ActivityList', 'ServiceList', 'BroadcastReceiverList') THEN 'component' WHEN category = 'URLDomainList' THEN 'url' ELSE 'unknown' END AS route, count(*) AS n FROM s GROUP BY 1, 2, 3""",
    "redact_secrets": """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type || ' Bearer <REDACTED> x <REDACTED_KEY> <REDACTED_KEY> ' || CAST(event_id AS VARCHAR)
 ELSE 'my.api_key=<REDACTED>; X-Auth-Token: <REDACTED>, --password <REDACTED> {"secrets": <REDACTED>, "n": 1} {\\"client_secret\\": <REDACTED>} end' END AS redacted FROM events""",
    "redact_map_keys": "SELECT event_id, event_type AS kind, '<REDACTED>' AS api_key, '<REDACTED>' AS token FROM events",
    "redact_nested": """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'no json password=<REDACTED>' ELSE '{"kind": "' || event_type || '", "inner": {"a": {"api_key": "<REDACTED>", "n": ' || CAST(event_id AS VARCHAR)
 || '}, "list": ["{\\"password\\": \\"<REDACTED>\\"}", "Bearer <REDACTED>", "' || event_type || '"]}, "said": "{\\"token\\": \\"<REDACTED>\\", \\"what\\": \\"' || event_type || '\\", \\"deep\\": [{\\"client_secret\\": \\"<REDACTED>\\"}]}"}' END AS redacted FROM events""",
    "keyword_search": "SELECT doc_id, source FROM documents WHERE contains(text, 'tion') OR contains(text, 'ung') OR contains(source, 'tion') OR contains(source, 'ung') ORDER BY doc_id DESC LIMIT 20",
}
