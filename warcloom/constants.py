"""Fixed values.

Everything here must equal what archives already have on disk or in their
indexes, so it is stated literally and in one place.
"""

# Null marker and statuses used in crawl logs and indexes.
DASH = "-"
DEDUPED = "duplicate:digest"
REVISIT_MIME = "warc/revisit"
PDF_MIME = "application/pdf"
LOCAL_DNS_STATUS = 1001

# Labels under .uk that act as registries.
UK_SECOND_LEVEL = [
    "ac", "co", "gov", "judiciary", "ltd", "me", "mod", "net", "nhs", "nic", "org",
    "parliament", "plc", "sch",
]

# Endings that count as UK scope.
UK_SUFFIXES = [".uk", ".london", ".wales", ".cymru", ".scot"]

# Content-delivery SURTs always open for access.
CDN_SURTS = [
    "http://(com,wp,s0",
    "http://(com,wp,s1",
    "http://(com,wp,s2",
    "http://(com,wordpress,files,",
    "http://(com,twimg,",
    "http://(com,blogspot,bp,",
    "http://(com,blogblog,img1",
    "http://(com,blogblog,img2",
    "http://(com,squarespace,static)",
    "http://(net,typekit,use)",
    "http://(com,blogger,www)/img/",
    "http://(com,blogger,www)/static/",
    "http://(com,blogger,www)/dyn-css/",
    "http://(net,cloudfront,",
    "http://(com,googleusercontent,",
]

# Crawler log files expected in each launch folder.
STANDARD_LOGS = [
    "alerts.log",
    "crawl.log",
    "nonfatal-errors.log",
    "progress-statistics.log",
    "runtime-errors.log",
    "uri-errors.log",
]

# Document extensions.
DOCUMENT_EXTENSIONS = ["pdf", "doc", "docx", "xls", "xlsx", "ppt", "pptx", "odt"]

# Record kinds kept in the file store and their id prefix.
STORE_KINDS = ["files", "warcs", "logs", "crawl-logs"]
STORE_ID_PREFIX = "hdfs://"

# WARC record types worth indexing.
INDEXED_RECORD_TYPES = ["response", "revisit", "resource", "metadata", "conversion"]

# Web-archive file name endings.
ARCHIVE_FILE_PATTERN = r"\.(warc|arc)(\.gz)?$"

# File name patterns.
WARC_TIMESTAMP_PATTERN = r"^.*-([12][0-9]{16})-.*\.warc\.gz$"
RENDER_WARC_PATTERN = r"BL-.{4}-WEBRENDER-([a-z\-0-9]+)-([0-9]{14})-([a-z\-0-9]+)\.warc\.gz"

# Licence id standing for "inherited".
INHERITED_LICENCE = "1000"

# Access statements of title records.
RIGHTS_OPEN = "***Free access"
RIGHTS_READING_ROOM = "***Available only in our Reading Rooms"

# Fixed value: a launch without capture after this many seconds has failed.
LAUNCH_TIMEOUT_SECONDS = 43200
