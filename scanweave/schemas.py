"""Column layouts of the scan files and of the resolved DNS records, as DDL text."""

# Header of the TLS host scan, in file order.
HOSTS = (
    "id int, ip string, port int, server_name string, synStart int, synEnd int, "
    "scanEnd int, protocol int, cipher string, resultString string, error_data string, "
    "cert_id int, cert_hash string, pub_key_hash string, cert_valid int, "
    "tls_alerts_send string, peer_certificates string, tls_alerts_received string, "
    "client_hello string"
)

# Header of an already parsed certificate file, in file order.
PARSED_CERTS = (
    "id int, system_cert_store int, sha1 string, sha256 string, subject string, "
    "issuer string, notBefore timestamp, notAfter timestamp, basicConstraints boolean, "
    "isCa boolean, sha256PubKey string, numAltNames int, altNames string"
)

# Columns of a DNS pair file, which has no header.
DNS_PAIRS = "ip string, domain string"

DNS_RECORD = "name string, data struct<answers: array<struct<name: string, type: string, data: string>>>"

# Holds the text of a row that did not fit its schema; null for good rows.
CORRUPT = "_corrupt"

# What the graph needs of each snapshot table.
GRAPH_COLUMNS = {
    "hosts": "id int, ip string, server_name string, cert_hash string, cert_valid int",
    "http": "id string, Location string",
    "certs": (
        "sha1 string, sha256 string, subject string, issuer string, notBefore timestamp, "
        "notAfter timestamp, numAltNames int, altNames array<string>"
    ),
    "dns": "ip string, domain string",
}
