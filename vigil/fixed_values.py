"""Fixed values. Results depend on them being exactly as written here."""

# Topic of each metric family.
TOPICS = {
    "cpu": "topic-cpu",
    "mem": "topic-mem",
    "net": "topic-net",
    "disk": "topic-disk",
}

# Metrics of each family, in record order. Families are in sending order.
FAMILY_METRICS = {
    "cpu": ["cpu_pct"],
    "mem": ["mem_pct"],
    "net": ["net_in", "net_out"],
    "disk": ["disk_io"],
}

# Date put before a time-only timestamp of TIME_ONLY_LENGTH characters.
DEFAULT_DATE = "2025-10-20"
TIME_ONLY_LENGTH = 8

STRICT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_OF_DAY_FORMAT = "HH:mm:ss"

# Window length, slide and offset in seconds.
WINDOW_SECONDS = 30
SLIDE_SECONDS = 10
OFFSET_SECONDS = 0

# Alert thresholds, and the one used for a name that is not configured.
THRESHOLDS = {
    "cpu_threshold": 87.97,
    "mem_threshold": 83.18,
    "net_in_threshold": 5338.75,
    "disk_io_threshold": 2696.29,
}
MISSING_THRESHOLD = 99999.0

# Alert texts: both sides high, left side high, right side high, none.
CPU_MEM_ALERTS = (
    "High CPU + Memory stress",
    "CPU spike suspected",
    "Memory saturation suspected",
)
NET_DISK_ALERTS = (
    "Network flood + Disk thrash suspected",
    "Possible DDoS",
    "Disk thrash suspected",
)
NO_ALERT = ""
