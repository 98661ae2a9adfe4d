"""DataFrame -> DataFrame operators; batch and (unless noted) streaming."""
