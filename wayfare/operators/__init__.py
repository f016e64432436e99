"""DataFrame-to-DataFrame building blocks shared by the reports and the streams."""
