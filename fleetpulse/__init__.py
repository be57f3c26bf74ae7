"""Fleet telemetry analytics as DataFrame transforms.

Every transform is ``DataFrame -> DataFrame`` and works unchanged on a batch
or a stream; only ``sources``, ``sinks`` and ``streaming`` touch I/O.
"""
