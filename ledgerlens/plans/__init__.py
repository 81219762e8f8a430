"""End-to-end jobs (bronze -> silver -> gold) and reporting views."""
