"""docloom.sinks"""
