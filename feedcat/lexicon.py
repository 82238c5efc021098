"""Lexicons and lookup tables.

Operators take these as parameters; the defaults below reproduce the
behaviour of the catalog tooling we re-implement.  Anything that must stay
equal to it for identical results is grouped in the FIXED VALUES block.
"""
from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must stay equal to the original tooling; natural order)
# ---------------------------------------------------------------------------

# Security keywords, matched by substring containment on a lower-cased blob.
SECURITY_KEYWORDS = [
    "cve", "vulnerability", "vuln", "exploit", "0day", "zero-day", "advisory", "patch",
    "malware", "ransomware", "phishing", "botnet", "trojan", "backdoor", "loader", "infostealer",
    "apt", "threat actor", "intrusion", "breach", "incident", "ioc", "tactic", "technique",
    "reverse engineering", "pwn", "pentest", "red team", "blue team", "dfir", "forensics",
    "edr", "siem", "splunk", "kql", "sigma", "yara",
    "kubernetes", "docker", "cloud security", "aws security", "azure security", "gcp security",
    "campaign", "payload", "initial access", "lateral movement", "persistence", "privilege escalation",
    "authentication bypass", "rce", "remote code execution", "xss", "sqli", "ssrf", "csrf",
    "denial of service", "data leak", "data exfiltration",
    "threat intelligence", "security research", "vulnerability disclosure", "bug bounty",
    "penetration testing", "security advisory", "zero trust", "supply chain attack",
    "memory corruption", "buffer overflow", "heap spray", "use-after-free",
    "command injection", "path traversal", "deserialization",
    "c2", "command and control", "cobalt strike", "metasploit",
    "mitre att&ck", "killchain", "ttp",
]

# Keywords worth 3 points instead of 1.
STRONG_KEYWORDS = [
    "cve", "exploit", "ransomware", "malware", "apt", "zero-day", "0day",
    "vulnerability", "advisory", "rce", "remote code execution",
    "threat intelligence", "vulnerability disclosure", "security research",
    "memory corruption", "buffer overflow", "command injection",
    "c2", "command and control", "mitre att&ck",
]

# Keywords of non-security content; two or more hits cost 2 points each.
NEGATIVE_KEYWORDS = [
    "recipe", "cooking", "fashion", "beauty", "lifestyle", "travel blog",
    "weight loss", "fitness tips", "relationship", "celebrity", "entertainment",
    "sports news", "movie review", "book review",
    "stock market", "cryptocurrency price", "nft", "defi yield",
    "seo tips", "social media marketing", "digital marketing", "affiliate",
    "wordpress tutorial", "web design tips",
]

# Ordered category rules: first rule with any matching pattern wins
# (case-insensitive regular-expression search; \b is a word boundary).
CATEGORY_RULES = [
    ("Vulnerabilities, CVEs", [r"\bcve\b", r"vulnerab", r"\b0day\b", r"zero-?day", r"advisory", r"\bpatch\b", r"\brce\b"]),
    ("Exploits", [r"\bexploit\b", r"\bpoc\b", r"proof of concept", r"weaponiz"]),
    ("Malware & Ransomware", [r"malware", r"ransomware", r"infostealer", r"loader", r"botnet", r"trojan", r"backdoor"]),
    ("Threat Intel", [r"\bapt\b", r"threat actor", r"campaign", r"\bioc\b", r"tactic", r"technique"]),
    ("DFIR & Forensics", [r"\bdfir\b", r"forensic", r"incident", r"breach", r"\bedr\b", r"\bsiem\b", r"splunk", r"\bkql\b", r"sigma"]),
    ("Cloud Security", [r"kubernetes", r"docker", r"\baws\b", r"\bazure\b", r"\bgcp\b", r"supply chain"]),
    ("Offensive Security", [r"pentest", r"pwn", r"red team"]),
]
DEFAULT_CATEGORY = "Security (General)"

# Paths probed on every candidate site.
COMMON_FEED_PATHS = [
    "/feed", "/feed/", "/rss", "/rss/", "/rss.xml", "/atom.xml", "/feed.xml", "/index.xml",
    "/blog/rss", "/blog/rss.xml", "/blog/atom.xml", "/blog/feed", "/blog/feed.xml",
    "/rss/index.xml",
]

# Preferred feed paths, most preferred first (rank = index; others rank 12).
FEED_PATH_PREFERENCE = [
    "/feed", "/atom.xml", "/rss.xml", "/feed.xml", "/index.xml",
    "/blog/feed", "/blog/atom.xml", "/blog/rss.xml", "/blog/feed.xml",
    "/rss", "/blog/rss", "/rss/index.xml",
]

# Hosts never crawled as candidate sites (exact match on the host).
IGNORED_HOSTS = [
    "github.com", "gist.github.com", "raw.githubusercontent.com", "api.github.com",
    "reddit.com", "old.reddit.com", "np.reddit.com", "x.com", "twitter.com", "t.co",
    "linkedin.com", "www.linkedin.com", "facebook.com", "www.facebook.com",
    "youtube.com", "www.youtube.com", "youtu.be", "img.shields.io", "shields.io",
    "badge.fury.io",
]

# Link paths ending in one of these are assets, not sites.
ASSET_EXTENSIONS = [
    ".png", ".jpg", ".jpeg", ".gif", ".svg", ".css", ".js", ".ico",
    ".pdf", ".zip", ".tar", ".gz", ".tgz", ".bz2", ".7z",
]

# Query keys dropped from the catalog dedup key (plus any key starting utm_).
TRACKING_QS_PREFIXES = ["utm_"]
TRACKING_QS_KEYS = ["fbclid", "gclid", "mc_cid", "mc_eid", "ref", "source"]

# Feed types accepted without a warning.
ALLOWED_TYPES = ["rss", "atom", ""]

# Review bucket -> label written into the candidate item.
BUCKET_LABELS = [
    ("crypto-and-blockchain-security", "Crypto & Blockchain Security"),
    ("cybercrime-darknet-and-leaks", "Cybercrime, Darknet & Leaks"),
    ("dfir-and-forensics", "DFIR & Forensics"),
    ("general-security-and-blogs", "Security (General) & Blogs"),
    ("government-cert-and-advisories", "Government / CERT & Advisories"),
    ("leaks-and-breaches", "Leaks & Breaches"),
    ("malware-and-threat-research", "Malware & Threat Research"),
    ("osint-communities-and-subreddits", "OSINT, Communities & Subreddits"),
    ("podcasts-and-youtube", "Podcasts & YouTube"),
    ("vendors-and-product-blogs", "Vendors & Product Blogs"),
    ("vulnerabilities-cves-and-exploits", "Vulnerabilities, CVEs & Exploits"),
]

# Bucket cascade.  "blob" groups test the lower-cased
# title+description+site+keywords+category text, "category" groups test the
# lower-cased suggested category only; substring containment, first hit wins.
BUCKET_RULES = [
    ("blob", "crypto-and-blockchain-security", ["crypto", "blockchain", "web3", "defi", "wallet", "exchange"]),
    ("blob", "podcasts-and-youtube", ["podcast", "youtube", "video", "episode"]),
    ("blob", "osint-communities-and-subreddits", ["osint", "subreddit", "reddit", "community", "forum", "discord", "telegram"]),
    ("blob", "cybercrime-darknet-and-leaks", ["darknet", "carding", "fraud", "ransom", "extortion", "leak site", "cybercrime"]),
    ("blob", "leaks-and-breaches", ["breach", "leak", "exposed", "data leak", "compromised"]),
    ("blob", "government-cert-and-advisories", ["cert", "cisa", "enisa", "nvd", "advisory", "bulletin", ".gov"]),
    ("category", "vulnerabilities-cves-and-exploits", ["vulnerab", "cves", "cve", "exploit", "offensive"]),
    ("category", "dfir-and-forensics", ["dfir", "forensic"]),
    ("category", "malware-and-threat-research", ["malware", "ransom", "threat intel", "threat"]),
    ("blob", "vendors-and-product-blogs", ["release", "product", "vendor", "update", "changelog", "patch"]),
]
DEFAULT_BUCKET = "general-security-and-blogs"

# Canonical category names that differ from two bucket labels above.
CANONICAL_BUCKET_LABELS = [
    ("general-security-and-blogs", "General Security & Blogs"),
    ("government-cert-and-advisories", "Government, CERT & Advisories"),
]

# Operating defaults.
MIN_SCORE = 6
FIRST_ENTRIES = 15
MIN_FEED_BODY_BYTES = 80
SAMPLE_ENTRIES = 5
DESCRIPTION_MAX = 220
SLUG_MAX = 50
# ---------------------------------------------------------------------------
# end of FIXED VALUES
# ---------------------------------------------------------------------------


class Lexicon:
    """Scoring lexicon passed to the scoring and classification operators."""

    def __init__(self, keywords=None, strong=None, negative=None,
                 category_rules=None, default_category=DEFAULT_CATEGORY,
                 bucket_rules=None, default_bucket=DEFAULT_BUCKET):
        self.keywords = list(SECURITY_KEYWORDS if keywords is None else keywords)
        self.strong = set(STRONG_KEYWORDS if strong is None else strong)
        self.negative = list(NEGATIVE_KEYWORDS if negative is None else negative)
        self.category_rules = list(CATEGORY_RULES if category_rules is None else category_rules)
        self.default_category = default_category
        self.bucket_rules = list(BUCKET_RULES if bucket_rules is None else bucket_rules)
        self.default_bucket = default_bucket

    def weights(self):
        return [(k, 3 if k in self.strong else 1) for k in self.keywords]


DEFAULT_LEXICON = Lexicon()
