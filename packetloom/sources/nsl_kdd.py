"""The NSL-KDD connection records: CSV lines to typed columns and vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.schema import FEATURES

# The 41 feature columns of the data set, in file order.
COLUMNS = [
    "duration", "protocol_type", "service", "flag", "src_bytes", "dst_bytes", "land", "wrong_fragment", "urgent",
    "hot", "num_failed_logins", "logged_in", "num_compromised", "root_shell", "su_attempted", "num_root",
    "num_file_creations", "num_shells", "num_access_files", "num_outbound_cmds", "is_host_login",
    "is_guest_login", "count", "srv_count", "serror_rate", "srv_serror_rate", "rerror_rate", "srv_rerror_rate",
    "same_srv_rate", "diff_srv_rate", "srv_diff_host_rate", "dst_host_count", "dst_host_srv_count",
    "dst_host_same_srv_rate", "dst_host_diff_srv_rate", "dst_host_same_src_port_rate",
    "dst_host_srv_diff_host_rate", "dst_host_serror_rate", "dst_host_srv_serror_rate", "dst_host_rerror_rate",
    "dst_host_srv_rerror_rate",
]

# Categories of the three nominal columns, in encoding order.
NOMINAL = {
    "protocol_type": ["tcp", "udp", "icmp"],
    "service": [
        "http", "smtp", "finger", "domain_u", "auth", "telnet", "ftp", "ftp_data", "other", "private", "pop_3",
        "ntp_u", "eco_i", "ecr_i", "ssh", "imap4", "ctf", "login", "dns",
    ],
    "flag": ["SF", "S0", "REJ", "RSTR", "RSTO", "SH", "S1", "S2", "S3", "OTH"],
}

# Attack labels of each category.
ATTACKS = {
    "normal": ["normal"],
    "dos": [
        "back", "land", "neptune", "pod", "smurf", "teardrop", "apache2", "udpstorm", "processtable", "mailbomb",
        "worm",
    ],
    "probe": ["satan", "ipsweep", "nmap", "portsweep", "mscan", "saint"],
    "r2l": [
        "guess_passwd", "ftp_write", "imap", "phf", "multihop", "warezmaster", "warezclient", "spy", "xlock",
        "xsnoop", "snmpguess", "snmpgetattack", "httptunnel", "sendmail", "named",
    ],
    "u2r": ["buffer_overflow", "loadmodule", "rootkit", "perl", "sqlattack", "xterm", "ps"],
}

NUMERIC = [c for c in COLUMNS if c not in NOMINAL]


def attack_category(label: Column | str) -> Column:
    """Category of an attack label; ``unknown`` for any other text."""
    value = F.lower(F.trim(label if isinstance(label, Column) else F.col(label)))
    out = F.lit(None).cast("string")
    for category, names in ATTACKS.items():
        out = F.coalesce(out, F.when(value.isin(names), category))
    return F.coalesce(out, F.lit("unknown"))


def one_hot(value: Column | str, categories: list[str]) -> Column:
    """0/1 vector, case-insensitive; all zeros for an unknown value.

    One lookup in a constant map of ready vectors, so the value is normalised once however many categories there are.
    """
    text = F.lower(F.trim(value if isinstance(value, Column) else F.col(value)))
    names = [c.lower() for c in categories]

    def vector(name: str | None) -> Column:
        return F.array(*[F.lit(float(c == name)) for c in names])

    ready = F.create_map(*[part for name in dict.fromkeys(names) for part in (F.lit(name), vector(name))])
    return F.coalesce(F.element_at(ready, text), vector(None))


def parse(lines: DataFrame, text: str = "value") -> DataFrame:
    """CSV lines to typed columns plus label, category, binary label and difficulty.

    Lines with fewer than 42 fields are skipped; unreadable numbers become 0.
    """
    others = [c for c in lines.columns if c != text]
    split = lines.select(*others, F.split(text, ",").alias("_f")).where(F.size("_f") >= 42)
    # one small loop over the fields; 41 casts side by side are a method too long for the JVM to compile
    number = F.transform(F.slice("_f", 1, len(COLUMNS)), lambda x: F.coalesce(F.trim(x).try_cast("double"), F.lit(0.0)))
    split = split.select("*", number.alias("_n"))
    fields = [
        (F.trim(F.get("_f", F.lit(k))) if name in NOMINAL else F.get("_n", F.lit(k))).alias(name) for k, name in enumerate(COLUMNS)
    ]
    label = F.lower(F.trim(F.get("_f", F.lit(41))))
    difficulty = F.coalesce(F.trim(F.get("_f", F.lit(42))).try_cast("int"), F.lit(0))
    category = attack_category(label)
    return split.select(
        *others, *fields, label.alias("label"), category.alias("category"),
        F.when(category == "normal", "normal").otherwise("anomaly").alias("binary_label"),
        difficulty.alias("difficulty"),
    )


def load(spark: SparkSession, path: str, max_records: int | None = None) -> DataFrame:
    """Records of a file or folder; ``max_records`` counts raw lines, bad ones included."""
    lines = spark.read.text(path)
    return parse(lines if max_records is None else lines.limit(max_records))


def encode(records: DataFrame) -> DataFrame:
    """Add ``vector``: 70 numbers, nominal columns one-hot encoded in place."""
    parts = [
        one_hot(name, NOMINAL[name]) if name in NOMINAL else F.array(F.col(name)) for name in COLUMNS
    ]
    return records.withColumn("vector", F.concat(*parts))


def map_to_features(records: DataFrame) -> DataFrame:
    """The 22 traffic features approximated from a connection record.

    Fixed values: which position of the vector feeds which feature, and the constants. Reads the encoded vector by position. After the one-hot part, position 20 of
    the numeric block feeds ``syn_ratio`` and position 22 ``rst_ratio``.
    """
    after = 1 + sum(len(v) for v in NOMINAL.values())
    coded = records if "vector" in records.columns else encode(records)
    at = lambda k: F.get("vector", F.lit(k))
    numeric = lambda k: at(after + k)
    src_bytes, dst_bytes, duration = numeric(0), numeric(1), at(0)
    count, srv_count = numeric(18), numeric(19)
    values = {
        "avg_packet_size": src_bytes,
        "max_packet_size": src_bytes,
        "avg_inter_arrival_time": duration,
        "packets_per_second": count / F.greatest(duration, F.lit(1.0)),
        "tcp_ratio": at(1),
        "udp_ratio": at(2),
        "icmp_ratio": at(3),
        "unique_src_ports": F.lit(1.0),
        "unique_dst_ports": F.floor(srv_count).cast("double"),
        "well_known_port_ratio": F.when(srv_count < 1024, 1.0).otherwise(0.0),
        "unique_destinations": F.floor(count).cast("double"),
        "unique_sources": F.lit(1.0),
        "avg_bytes_per_connection": dst_bytes,
        "syn_ratio": numeric(20),
        "ack_ratio": F.when(at(1) != 0, 1.0).otherwise(0.0),
        "rst_ratio": numeric(22),
        "hour_of_day": F.lit(12.0),
        "is_business_hours": F.lit(1.0),
    }
    kept = [c for c in records.columns if c not in COLUMNS and c != "vector"]
    return coded.select(*kept, *[values.get(f, F.lit(0.0)).cast("double").alias(f) for f in FEATURES])
