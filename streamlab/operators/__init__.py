"""DataFrame -> DataFrame operators; none of them knows whether its input is a stream."""
