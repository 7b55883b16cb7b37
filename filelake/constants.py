"""File types, key layout, limits and retrieval defaults."""

# Supported extension, category, MIME type.
FILE_TYPES = (
    (".bmp", "images", "image/bmp"),
    (".gif", "images", "image/gif"),
    (".jpg", "images", "image/jpeg"),
    (".jpeg", "images", "image/jpeg"),
    (".png", "images", "image/png"),
    (".pdf", "docs", "application/pdf"),
    (".docx", "docs", "application/vnd.openxmlformats-officedocument.wordprocessingml.document"),
    (".xlsx", "docs", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"),
    (".pptx", "docs", "application/vnd.openxmlformats-officedocument.presentationml.presentation"),
    (".txt", "docs", "text/plain"),
    (".html", "docs", "text/html"),
    (".mp3", "media", "audio/mpeg"),
    (".wav", "media", "audio/wav"),
    (".mp4", "media", "video/mp4"),
    (".mov", "media", "video/quicktime"),
)
DEFAULT_MIME = "application/octet-stream"

# Key prefixes of the mirror.
PREFIXES = {
    "images": "mirror/images/",
    "docs": "mirror/docs/",
    "media": "mirror/media/",
}
META_PREFIX = "mirror/meta/"

# Limits in bytes. A size strictly above its limit is skipped.
MAX_FILE_BYTES = 150 * 1024**2
MAX_ARCHIVE_BYTES = 10 * 1024**3
MAX_MEMBER_BYTES = 1024**3
MAX_IMAGE_BYTES = 20 * 1024**2

# Retrieval and import defaults.
COMBINED_TOP_K = 5
SNIPPET_CHARS = 120
IMPORT_BATCH = 50
LEAF_SIZE = 500
LEAF_SEARCH_FRACTION = 0.10
# Fixed value: bytes read from an object at a time.
CHUNK_BYTES = 8 * 1024 * 1024
# URIs of objects in order, images without an extension and documents with one.
IMAGE_URI = r"/mirror/images/([^/]+)$"
DOC_URI = r"/mirror/docs/([^/]+)\.[a-z]+$"

# BM25 parameters and the precision at which scores are compared.
BM25_K1 = 1.2
BM25_B = 0.75
SCORE_DIGITS = 6
