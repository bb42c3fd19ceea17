"""Fixed values.

Names, codes, word lists, weights and patterns that results must agree on.  They
are data, not logic: everything that uses them lives in the other modules.
"""

# --- log types ---------------------------------------------------------------

LOG_TYPES = (
    "app-ctrl attack content dlp emailfilter event generic history im sniffer traffic virus "
    "voip webfilter netscan fct-event fct-traffic fct-netscan waf gtp dns ssh ssl file-filter "
    "asset protocol siem ztna security"
).split()
LOG_TYPE_ALIASES = {"anomaly": "attack", "icap": "protocol", "virtual-patch": "security"}

# --- field names per table ---------------------------------------------------

COMMON_FIELDS = (
    "date time itime eventtime devname devid vd logid type subtype level action srcip dstip "
    "msg user"
).split()
EXTRA_FIELDS = {
    "traffic": "srcport dstport proto policyid service app appcat srcintf dstintf sentbyte "
    "rcvdbyte duration sessionid srccountry dstcountry unauthuser hostname dstname",
    "event": "ui cfgpath cfgattr status",
    "attack": "severity attack attackid srcport dstport proto service sessionid pcapurl cve ref "
    "policyid hostname url profile",
    "virus": "virus filename url service srcport dstport proto profile eventtype filehash",
    "webfilter": "hostname url catdesc cat service srcport dstport proto profile eventtype "
    "reqtype sentbyte rcvdbyte",
    "app-ctrl": "app appcat apprisk hostname url service srcport dstport proto profile eventtype "
    "sentbyte rcvdbyte",
    "dns": "qname qtype qclass xid srcport dstport proto profile eventtype catdesc",
}
ENTITY_FIELDS = {
    "device": "name ip sn hostname desc os_ver mr patch platform_str conn_status dev_status "
    "mgmt_mode adm_usr vdom hdisk_size build",
    "task": "id title src user adom state percent num_done num_err num_lines num_warn start_tm "
    "end_tm",
    "alert": "alertid severity status ackflag acknowledged alerttime timestamp createtime "
    "lastlogtime eventtype alerttype triggername name logdesc description extrainfo subject "
    "subject_details devname devid csf epid epname epip euid dstepname dstepip event_details "
    "groupby1 groupby2 target",
    "incident": "incid name severity status category description createtime lastupdate timestamp "
    "endpoint reporter lastuser incident_reporter assigned_to remedy_executor remedy_approver "
    "grpby epid euid alertid",
    "endpoint": "epid epname epip euid user detectkey",
    "enduser": "euid euname email epids",
    "report": "tid title state",
}

# --- columns shown when the caller names none --------------------------------

DEFAULT_COLUMNS = {
    "traffic": "date time devname srcip srcport dstip dstport proto action service app policyid "
    "sentbyte rcvdbyte duration user sessionid srccountry dstcountry",
    "event": "date time devname level subtype action user ui msg status",
    "attack": "date time devname severity attack attackid srcip srcport dstip dstport proto "
    "action service policyid cve sessionid pcapurl msg",
    "virus": "date time devname action virus filename filehash url srcip dstip user service msg",
    "webfilter": "date time devname action hostname url catdesc srcip dstip user sentbyte "
    "rcvdbyte msg",
    "app-ctrl": "date time devname action app appcat apprisk hostname srcip dstip user sentbyte "
    "rcvdbyte msg",
    "dns": "date time devname action qname qtype catdesc srcip dstip user msg",
    "alert": "alertid alerttime lastlogtime severity status ackflag acknowledged eventtype "
    "triggername subject devname epid epname epip euid groupby1 groupby2",
    "incident": "incid name severity status category createtime lastupdate timestamp endpoint "
    "reporter lastuser assigned_to epid euid alertid",
    "endpoint": "epid epname epip euid user",
    "enduser": "euid euname epids",
    "device": "name ip sn hostname os_ver mr patch platform_str conn_status dev_status vdom",
    "task": "id title state percent user adom start_tm end_tm num_err num_warn",
}

# --- other spellings of field names ------------------------------------------

LOG_ALIASES = {
    "source_ip": "srcip",
    "src_ip": "srcip",
    "destination_ip": "dstip",
    "dest_ip": "dstip",
    "dst_ip": "dstip",
    "source_port": "srcport",
    "src_port": "srcport",
    "destination_port": "dstport",
    "dest_port": "dstport",
    "dst_port": "dstport",
    "protocol": "proto",
    "application": "app",
    "application_category": "appcat",
    "policy_id": "policyid",
    "session_id": "sessionid",
    "username": "user",
    "user_name": "user",
    "device_name": "devname",
    "device_id": "devid",
    "source_interface": "srcintf",
    "destination_interface": "dstintf",
    "bytes_sent": "sentbyte",
    "sent_bytes": "sentbyte",
    "bytes_received": "rcvdbyte",
    "received_bytes": "rcvdbyte",
    "attack_name": "attack",
    "source_country": "srccountry",
    "destination_country": "dstcountry",
    "message": "msg",
    "web_category": "catdesc",
    "category_description": "catdesc",
}
ENTITY_ALIASES = {
    "device": {
        "device_name": "name",
        "serial": "sn",
        "serial_number": "sn",
        "os_version": "os_ver",
        "platform": "platform_str",
        "connection_status": "conn_status",
        "description": "desc",
    },
    "task": {"task_id": "id", "status": "state", "progress": "percent"},
    "alert": {
        "alert_id": "alertid",
        "event_type": "eventtype",
        "device_name": "devname",
        "trigger": "triggername",
        "acknowledged_flag": "ackflag",
        "endpoint_name": "epname",
        "endpoint_ip": "epip",
        "endpoint_id": "epid",
        "enduser_id": "euid",
    },
    "incident": {
        "incident_id": "incid",
        "title": "name",
        "banner": "name",
        "owner": "assigned_to",
        "assignee": "assigned_to",
        "endpoint_id": "epid",
        "enduser_id": "euid",
    },
    "endpoint": {
        "endpoint_id": "epid",
        "host": "epname",
        "hostname": "epname",
        "ip": "epip",
        "username": "user",
    },
    "enduser": {"enduser_id": "euid", "user": "euname", "username": "euname"},
    "report": {"report_id": "tid", "id": "tid", "name": "title", "status": "state"},
}

# --- enumerations ------------------------------------------------------------

CONNECTION_CODES = {"unknown": 0, "up": 1, "down": 2}
TASK_CODES = {
    "pending": 0,
    "running": 1,
    "cancelling": 2,
    "cancelled": 3,
    "done": 4,
    "error": 5,
    "aborting": 6,
    "aborted": 7,
    "warning": 8,
    "to_continue": 9,
    "unknown": 10,
}
SEVERITIES = "critical high medium low info".split()
TRAFFIC_ACTIONS = "accept deny close drop ip-conn timeout".split()
IPS_ACTIONS = "detected blocked dropped reset pass clear_session".split()
EVENT_LEVELS = "emergency alert critical error warning notice information debug".split()
EVENT_SUBTYPES = (
    "system vpn user router wireless wad endpoint ha security-rating connector sdwan"
).split()

# --- time windows ------------------------------------------------------------

# Preset name -> minutes, from narrow to wide.
PRESET_MINUTES = {
    "now": 5,
    "5-min": 5,
    "15-min": 15,
    "30-min": 30,
    "1-hour": 60,
    "2-hour": 120,
    "6-hour": 360,
    "12-hour": 720,
    "24-hour": 1440,
    "1-day": 1440,
    "2-day": 2880,
    "7-day": 10080,
    "30-day": 43200,
    "90-day": 129600,
}
REPORT_PRESETS = "1-hour 6-hour 12-hour 24-hour 1-day 7-day 30-day 90-day".split()
ANCHOR_MAX_FUTURE_DAYS = 2
ANCHOR_MAX_PAST_DAYS = 400
SWEEP_WIDEST = "7-day"
VPN_NARROWEST = "90-day"

# --- limits and labels -------------------------------------------------------

LOG_PAGE_MAX = 1000
ENTITY_PAGE_MAX = 2000
HIGH_VOLUME_FLOOR = 10_000
POLICY_QUERY_BUDGET = 24
POLICY_MAX_SLICES = 4
ABSENT_WORDS = ["", "n/a", "null", "none", "unknown"]
SERIAL_PATTERN = r"^(FG|FM|FW|FA|FS|FD|FP|FC|FV)[A-Z0-9]{10,20}$"
VM_SERIAL_PATTERN = r"^(FG|FM|FW|FA|FS|FD|FP|FC|FV)[A-Z0-9]{0,2}-VM[A-Z0-9]{4,18}$"
FIELD_NAME_PATTERN = r"^[a-z0-9_][a-z0-9_.-]*$"

# --- exact grouping: dimension -> (view, population) --------------------------

GROUP_VIEWS = {
    "srcip": ("top-sources", "traffic"),
    "dstip": ("top-destinations", "traffic"),
    "catdesc": ("top-websites", "webfilter"),
    "attack": ("top-threats", "attack"),
    "threat": ("top-threats", "attack"),
    "policyid": ("policy-hits", "traffic"),
    "dstcountry": ("top-countries", "traffic"),
}
VIEW_SORT = {
    "top-sources": "bandwidth",
    "top-destinations": "bandwidth",
    "top-applications": "bandwidth",
    "top-websites": "bandwidth",
    "top-threats": "threatweight",
    "top-cloud-applications": "sessions",
    "policy-hits": "counts",
}
VIEW_FILTERS = {
    "top-sources": "srcip",
    "top-destinations": "dstip",
    "policy-hits": "policyid",
    "top-countries": "dstcountry",
    "top-threats": "threat",
}
ALERT_GROUPS = "severity status".split()
INCIDENT_GROUPS = "severity status category".split()

# --- correlation keys --------------------------------------------------------

ALERT_INCIDENT_KEYS = "incids incid incidentid incident_id".split()
INCIDENT_ALERT_KEYS = "alertids alertid alert_ids".split()
USER_ENDPOINT_KEYS = "epid epids eplist".split()
INDICATOR_TYPES = {"ip": "IP", "url": "URL", "domain": "Domain"}
INDICATOR_FIELDS = {"IP": "srcip", "Domain": "hostname", "URL": "url", "Hash": "checksum"}
SWEEP_LOG_TYPES = "traffic attack app-ctrl dns".split()
HANDLER_FIELDS = "alerttype eventtype triggername name logdesc".split()
BEHAVIOUR_MARKERS = (
    "botnet compromised ioc beacon c2 command-and-control anomaly lateral exfil"
).split()

# --- scoring -----------------------------------------------------------------

PRIORITY_BY_SEVERITY = {"critical": "urgent", "high": "high", "medium": "medium", "low": "low"}
VULNERABILITY_POINTS = {"critical": 25, "high": 10, "medium": 3, "low": 1}
THREAT_POINTS = {"critical": 25, "high": 10, "medium": 3}
POINTS_PER_FAILURE = 5
# Percent weights of the three risk dimensions.
RISK_WEIGHTS = {"vulnerability": 40, "threat": 35, "auth": 25}
RISK_BANDS = {"critical": 75, "high": 50, "medium": 25}
VULN_COUNTER_LABELS = {
    "cnt_cri": "critical",
    "cnt_hig": "high",
    "cnt_med": "medium",
    "cnt_low": "low",
    "cnt_inf": "info",
}
ANOMALY_PERCENTILE = 90.0

# --- masking -----------------------------------------------------------------

# Semantic type -> the columns that carry it.
MASKED_COLUMNS = {
    "ip": "srcip dstip trueclntip transip tranip ipaddr botnetip ip nat locip remip assignip "
    "tunnelip tunnelsrcip tunneldstip srcremote vipincomingip dns_ip ddnsserver gateway "
    "domainctrlip epip dstepip ipv6 src_ip dst_ip",
    "mac": "srcmac dstmac mastersrcmac masterdstmac mac bssid stamac tamac source_mac",
    "hostname": "srcname dstname hostname fqdn host dst_host host_name dns_name servername "
    "serveraddr remotedevname domainctrlname device",
    "ip_or_host": "epname dstepname srcip_hostname dstip_hostname endpoint dstendpoint "
    "srcendpoint",
    "username": "user dstuser unauthuser xauthuser eapuser useralt clouduser aiuser initiator "
    "admin remoteadmin euname dsteuname domainctrlusername reporter lastuser",
    "domain": "qname srcdomain botnetdomain domainctrldomain scertcname domain",
    "email": "sender recipient from to cc collectedemail dstcollectedemail email assigned_to "
    "remedy_executor remedy_approver",
    "text": "msg logdesc subject extrainfo ui prompt description srcuuid_name dstuuid_name "
    "filter filter_applied fields_returned warnings message reason pivot pivot_filter entity_ref "
    "headline",
}
DEVICE_COLUMNS = (
    "devname devid sn serialno csf sndetected snclosest fortigate detectkey devs dev_name"
).split()
# A record with one of these beside ``name`` is a device, and ``name`` is its name.
DEVICE_SHAPE_COLUMNS = (
    "sn serialno os_ver os_type platform_str conn_status dev_status ha_mode mr patch"
).split()
TARGET_TYPES = {
    "ip": "ip",
    "domain": "domain",
    "device": "ip_or_host",
    "endpoint": "ip_or_host",
    "user": "username",
    "host_name": "ip_or_host",
}
UNMASKED_VALUES = ["", "N/A", "n/a", "unknown", "none", "-"]
UNREPRESENTABLE_MARK = "masked-unrepresentable-"
IPV4_PATTERN = r"\b(?:\d{1,3}\.){3}\d{1,3}\b"
MAC_PATTERN = r"\b[0-9a-fA-F]{2}(?::[0-9a-fA-F]{2}){5}\b"
EMAIL_PATTERN = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"

# --- evidence -----------------------------------------------------------------
# Fixed output: the sentences that tell why an entity is anomalous.

EVIDENCE = {
    "anomalous": "ANOMALOUS",
    "normal": "normal",
    "ranked": "risk_score at %sth percentile of %s scored endpoints (threshold %s) -> %s",
    "unranked": "risk_score percentile unavailable (estate too small to rank, %s scored endpoint(s)); percentile flag not applied",
    "serious": "carries serious vulnerabilities (%s) -> ANOMALOUS",
    "not serious": "no critical/high vuln-stats",
    "detections": "%s behavioural/IOC detection(s) in the window -> ANOMALOUS",
    "no detections": "no behavioural/IOC detections in the window",
    "detections unknown": "behavioural detections unavailable; that flag not applied",
}

# --- redaction ---------------------------------------------------------------

SENSITIVE_WORDS = (
    "password passwd pass adm_pass adm_passwd api_token apikey token session sid authorization "
    "auth secret key credential"
).split()
TOO_GENERIC_FOR_TEXT = "key auth pass".split()
REDACTED = "***REDACTED***"
HEX_RUN_PATTERN = r"\b[a-fA-F0-9]{20,}\b"
