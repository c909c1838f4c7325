"""Tables in and out: log tables, metric history, audit exports, fitted models."""
